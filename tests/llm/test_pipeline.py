"""The pipeline's stages on a small table with every odd case, and the registered queries."""

import numpy as np

from tests.llm.cases import DOCS, bag, docs


def corpus(spark):
    rng = np.random.default_rng(7)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = list(DOCS)
    for n in range(300):
        t = list(rng.choice(vocabulary, 60))
        if n % 5 == 0:
            t[30] = "idiot"
        rows.append((100 + n, " ".join(t), "abc"[n % 3]))
        if n % 10 == 1:
            rows.append((1000 + n, " ".join([*t, "more"]), "a"))
    d = docs(spark, rows, clash=False).selectExpr("doc_id", "text", "'en' AS lang", "source", "CAST(length(text) AS bigint) AS n_chars", "'x' AS score", "'y' AS copies")
    return d, rows


def test_stages(spark, tmp_path):
    import corpus_pipeline as P
    d, rows = corpus(spark)
    spark.createDataFrame([(100 + n, 1, int(n % 5 == 0)) for n in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "personal_data", "mixing", "packing"]
    stages = dict(P.STAGES)

    clean = stages["toxicity"](spark, d, str(tmp_path))
    assert clean.columns == d.columns
    assert bag(clean, "doc_id", "text") == bag(d.filter("text is null or text not like '%idiot%'"), "doc_id", "text")

    one = stages["near_duplicates"](spark, clean, str(tmp_path))
    assert one.columns == d.columns
    ids = [r["doc_id"] for r in one.collect()]
    assert all(1000 + n not in ids for n in range(1, 300, 10) if n % 5) and all(100 + n in ids for n in range(300) if n % 5)
    # copies 1 and 2, 8 and both 9: one stays; texts without words all stay
    assert 1 in ids and 2 not in ids and 8 in ids and 9 not in ids and {3, 4, 5} <= set(ids)
    assert sum(r["doc_id"] is None and r["text"] is None for r in one.collect()) == 2

    hidden = stages["personal_data"](spark, one, str(tmp_path))
    assert hidden.columns == d.columns and hidden.count() == one.count()
    ten = hidden.filter("doc_id = 10").first()
    assert "example.com" not in ten["text"] and "[email]" in ten["text"] and ten["n_chars"] == len(ten["text"])

    mixed = stages["mixing"](spark, hidden, str(tmp_path))
    assert mixed.columns == d.columns
    from tidemark.llm.fair_mix import fair_mix
    taken = {r["doc_id"]: r["copies"] for r in fair_mix(hidden).filter("copies > 0").collect()}
    got: dict = {}
    for r in mixed.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == taken

    packed = stages["packing"](spark, mixed, str(tmp_path))
    assert packed.select("doc_id").distinct().count() == len(taken)
    for name, stage in P.STAGES:
        assert stage(spark, d.limit(0), str(tmp_path)).count() == 0, name


def test_registered(spark):
    import __spark_entry__ as E
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()
