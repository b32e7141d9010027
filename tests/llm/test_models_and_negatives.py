"""Language identification, whitening and hard negatives against plain versions of them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tests.llm.cases import DOCS, LONG, docs, rest
from tests.llm.test_vectors_and_pages import made, sound, table


def plain_spectrum(text):
    s = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    s = " " + " ".join(s.split()) + " "
    return {s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)} if s.strip() else set()


@pytest.mark.parametrize("piece", [1 << 20, 3])
def test_spectrum(monkeypatch, piece):
    from tidemark.llm import language_id as L
    monkeypatch.setattr(L, "PIECE", piece)
    for text in ["", None, "  \n", "123 --", "a", "Ab  c!d", "Èté é€😀 日本 x9y", "one two " * 50, LONG]:
        want = {sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g)) for g in plain_spectrum(text)}
        assert set(L.spectrum(text).tolist()) == want


def test_kernels_and_folded_weights():
    """Margins by the folded matrix are those of kernels with landmarks, whitened and weighed."""
    from tidemark.llm.language_id import Landmarks, Model, ridge
    rng = np.random.default_rng(5)
    made_up = ["".join(rng.choice(list(letters), 60)) for letters in ("abcd ef", "defgh i", "klmno a") for _ in range(20)]
    marks = Landmarks.of(made_up[::6])
    sets = [plain_spectrum(t) for t in made_up]
    want = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in sets[::6]] for a in sets])
    assert np.allclose(marks.kernel(made_up), want)
    y = np.repeat(np.eye(3) * 2 - 1, 20, 0)
    weights, bias = ridge(want, y)
    folded = np.add.reduceat((weights / np.sqrt(marks.sizes)[:, None])[marks.who], marks.start[:-1], 0)
    margins, known = Model(["a", "b", "c"], marks.vocabulary, folded, bias).margins(made_up + [None, "12"])
    assert np.allclose(margins[:-2], want @ weights + bias) and known.tolist() == [True] * 60 + [False] * 2
    assert (margins[:-2].argmax(1) == y.argmax(1)).mean() > .95


def test_languages(spark):
    from tidemark.llm.language_id import language_id
    some = spark.read.parquet(f"{SF_MID}/documents.parquet")
    found = language_id(some).join(some.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null").toPandas()
    assert len(found) > 200 and (found["lang"] == found["lang_pred"]).mean() > .98
    assert all(rest(i, 4) == 2 for i in found["doc_id"]) and found["score"].between(0, 1).all()


def test_odd_languages(spark):
    from tidemark.llm.language_id import language_id
    odd = docs(spark).withColumn("lang", F.when(F.col("source") == "a", "x").when(F.col("source") == "b", "y"))
    got = language_id(odd).collect()
    letters = [any(c.isalpha() for c in t or "") for _, t, _ in DOCS]
    assert len(got) == len(DOCS) and sum(r["lang_pred"] == "und" for r in got) == len(DOCS) - sum(letters)
    assert all(r["score"] == 0 for r in got if r["lang_pred"] == "und") and {r["lang_pred"] for r in got} <= {"x", "y", "und"}
    assert all(r["held_out"] == (rest(r["doc_id"], 4) == 2) for r in got)
    assert language_id(odd.limit(0)).count() == 0
    none = language_id(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(none) == len(DOCS) and all(r["lang_pred"] == "und" for r in none)


@pytest.mark.parametrize("seed", range(12))
def test_divide_and_conquer(seed):
    from tidemark.llm.whitening import eigen
    rng = np.random.default_rng(seed)
    n = [1, 2, 3, 8, 20, 64][seed % 6]
    spread = np.sort(rng.exponential(size=n))[::-1] if seed < 6 else np.sort(rng.integers(0, 3, n))[::-1].astype(float)
    axes, _ = np.linalg.qr(rng.normal(size=(n, n)))
    a = axes * spread @ axes.T
    values, vectors = eigen(a, n)
    scale = max(spread[0], 1e-300)
    assert np.abs(values - spread).max() < 1e-13 * scale and np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-13
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * scale


def plain_whitening(rows, dims):
    own = [(i, np.floor(256 * np.array(np.array(v, np.float32), np.float64)).astype(int)) for i, v, _ in rows if sound(v) and len(v) == dims]
    fit = np.unique([x for _, x in own], axis=0)
    n, s = len(fit), fit.sum(0)
    c = fit - s / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1], axes[:, ::-1]
    return own, n, s, values, axes


def test_whitening(spark):
    from tidemark.llm.whitening import whiten
    rows = made(4)
    got = whiten(table(spark, rows)).toPandas()
    rows_got = whiten(table(spark, rows)).collect()
    for dims in (16, 2):
        own, n, s, values, axes = plain_whitening(rows, dims)
        k = min(4, int((values > 1e-12 * values.sum()).sum()))
        some = got[got["n"] == n]
        assert len(some) == len(own) * k
        want = [(i, c + 1, int(((n * x - s) ** 2).sum()), z) for i, x in own
                for c, z in enumerate(np.abs((x - s / n) @ axes[:, :k] / np.sqrt(values[:k])))]
        found = [(r["vec_id"], r["component"], r["deviation"], abs(r["whitened"])) for r in rows_got if r["n"] == n]
        order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], round(r[3], 6))
        for a, b in zip(sorted(want, key=order), sorted(found, key=order), strict=True):
            assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-9
        share = some.groupby("component")["explained"].first().to_numpy()
        assert np.allclose(share, values[:k] / values.sum(), rtol=1e-9)
        assert some["identity_error"].max() < 1e-9 and some["identity_error"].nunique() == 1
    assert whiten(table(spark, rows).limit(0)).count() == 0
    alike = [(i, [1.0, 2.0], 1) for i in range(5)]
    assert whiten(table(spark, alike)).count() == 0


def test_whitening_of_huge_numbers(spark):
    from tidemark.llm.whitening import whiten
    rows = [(1, [1e30, 0.0], 1), (2, [-1e30, 1.0], 1), (3, [0.0, 3.0], 1)]
    got = whiten(table(spark, rows)).toPandas()
    assert set(got["vec_id"]) == {1, 2, 3} and np.isfinite(got["whitened"]).all() and got["deviation"].isna().any()


def plain_negatives(rows, every=100):
    ok = [(i, np.floor(256 * np.array(np.array(v, np.float32), np.float64)).astype(int), label)
          for i, v, label in rows if i is not None and label is not None and sound(v)]
    out = []
    for i, q, label in ok:
        if i % every:
            continue
        near = sorted((-int(q @ x), j, other) for j, x, other in ok if len(x) == len(q))
        for s, p, _ in [n for n in near if n[2] == label and n[1] != i][:5]:
            found = [(j, t) for t, j, other in near if other != label and -30 * s <= -100 * t <= -90 * s][:10]
            out += [(i, p, r + 1, j, -s, -t) for r, (j, t) in enumerate(found)]
    return out


@pytest.mark.parametrize("cells,part,chunk", [(32, 8192, 4096), (3, 40, 2), (1, 8192, 4096)])
def test_hard_negatives(spark, cells, part, chunk):
    from tidemark.llm.hard_negatives import hard_negatives
    rows = made(6)
    want = plain_negatives(rows, 50)
    got = hard_negatives(table(spark, rows), 50, cells=cells, part=part, chunk=chunk).collect()
    assert sorted(tuple(r) for r in got) == sorted(want) and len(want) > 100
    assert hard_negatives(table(spark, rows).limit(0)).count() == 0
    assert hard_negatives(table(spark, rows).filter("vec_id = 7")).count() == 0


def test_repeated_rows_are_candidates(spark):
    from tidemark.llm.hard_negatives import hard_negatives
    rows = [(100, [1, 1], 1), (1, [1, 1], 1), (2, [.5, .5], 2), (2, [.5, .5], 2), (3, [.5, .4], None), (4, [-1, 0], 2)]
    got = sorted(tuple(r) for r in hard_negatives(table(spark, rows)).collect())
    assert got == [(100, 1, 1, 2, 131072, 65536), (100, 1, 2, 2, 131072, 65536)]


@pytest.mark.parametrize("dims", [1, 5, 64, 130])
def test_intervals_hold_the_scores(dims):
    from tidemark.llm.hard_negatives import Coder, intervals
    rng = np.random.default_rng(dims)
    x = np.concatenate([rng.integers(-300, 300, (200, dims)), rng.integers(-3, 3, (50, dims)), np.full((5, dims), 7), np.zeros((2, dims), int)])
    coder = Coder.fit(x[::2].astype(float), 4)
    for cell in range(len(coder.centres)):
        low, high = intervals(coder, cell, x[:60], coder.codes(x, cell))
        true = x[:60] @ x.T
        assert (low <= true).all() and (true <= high).all()
    # near its centre, a code says much
    tight = coder.centres[0] + rng.normal(size=(50, dims))
    low, high = intervals(coder, 0, tight[:10], coder.codes(tight, 0))
    assert (high - low).mean() < 3 * dims + 1
