"""Vector operators against brute force; main text of pages against what was put in."""

import numpy as np
import pytest

from tests.llm.cases import roots


def table(spark, rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(
        [(i, None if v is None else [None if x is None else float(x) for x in v], label) for i, v, label in rows],
        "vec_id long, embedding array<float>, label int")
    for c in ("id", "block", "home", "shard", "score", "dims", "links", "part"):
        df = df.withColumn(c, F.lit("x"))
    return df


def made(seed, n=250, dims=16):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dims), int(rng.integers(3))) for i in range(n)]
    centre = rng.normal(size=dims)
    rows += [(1000 + i, centre + rng.normal(scale=.08, size=dims), 1) for i in range(80)]
    rows += [(2000 + i, rows[5][1] * (1 + i), 2) for i in range(20)] + [(2100 + i, rows[5][1], 2) for i in range(20)]
    rows += [(3000 + i, [1, .1 * i], 0) for i in range(12)]
    rows += [(4000, None, 1), (4001, [], 1), (4002, np.zeros(dims), 1), (4003, [float("nan")] + [0] * (dims - 1), 1),
             (4004, [None] + [1] * (dims - 1), 1), (4005, rows[0][1], None), (4006, [float("inf")] * dims, 1),
             (7, rows[7][1], rows[7][2]), (7, rows[7][1], rows[7][2]), (None, rows[8][1], rows[8][2]), (4050, np.zeros(dims), 1)]
    return rows


def sound(v):
    return v is not None and len(v) and not any(x is None or not np.isfinite(x) for x in v)


@pytest.mark.parametrize("part", [2048, 16])
def test_subspace_join(spark, part):
    from tidemark.llm.subspace_join import near_vectors
    rows = made(1)
    v = [np.array(np.array(x, np.float32), np.float64) if sound(x) and np.any(np.array(x) != 0) else None for _, x, _ in rows]
    links, count = [], [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if v[a] is None or v[b] is None or rows[a][2] is None or rows[a][2] != rows[b][2] or len(v[a]) != len(v[b]):
                continue
            if v[a] @ v[b] / np.sqrt((v[a] @ v[a]) * (v[b] @ v[b])) >= .98:
                links.append((a, b))
                count[a] += 1
                count[b] += 1
    root, least = roots(len(rows), links), {}
    for i, r in enumerate(root):
        if rows[i][0] is not None:
            least[r] = min(least.get(r, 1 << 60), rows[i][0])
    comp = [least.get(r) for r in root]
    want = [(rows[i][0], count[i], comp[i], rows[i][0] == comp[i]) for i in range(len(rows))]
    got = [tuple(r) for r in near_vectors(table(spark, rows), part=part).collect()]
    order = lambda t: tuple((x is None, x or 0) for x in t)
    assert sorted(got, key=order) == sorted(want, key=order) and len(links) > 2000
    assert near_vectors(table(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("shard,queries", [(8192, 512), (32, 2)])
def test_kd_search(spark, shard, queries):
    from tidemark.llm.kd_search import top_k
    rows = made(2)
    ok = [(i, np.floor(256 * np.array(np.array(x, np.float32), np.float64)).astype(np.int64)) for i, x, _ in rows if i is not None and sound(x)]
    want = set()
    for q, x in {(i, tuple(x)) for i, x in ok if i % 50 == 0}:
        found = sorted((-int(np.dot(x, y)), j) for j, y in ok if j != q and len(y) == len(x))[:5]
        want |= {(q, r + 1, j, -s) for r, (s, j) in enumerate(found)}
    got = [tuple(r) for r in top_k(table(spark, rows), shard=shard, queries=queries).collect()]
    assert sorted(got) == sorted(want) and len(want) > 25
    assert top_k(table(spark, rows).limit(0)).count() == 0


def test_kd_boxes_are_tight():
    from tidemark.llm.kd_search import kd_tree
    v = np.random.default_rng(3).integers(-9, 9, (500, 4))
    order, nodes, low, high = kd_tree(v, leaf=10)
    assert sorted(order) == list(range(500))
    for (a, b, left), lo, hi in zip(nodes, low, high):
        rows = v[order[a:b]]
        assert (rows.min(0) == lo).all() and (rows.max(0) == hi).all()
        assert left >= 0 or b - a <= 10 or not (hi - lo).any()


def test_kd_blocks_go_to_groups_without_broadcasts(spark, monkeypatch):
    """Blocks expanded to all shards and broadcast once filled the driver's memory."""
    from tidemark.llm import kd_search
    rng = np.random.default_rng(12)
    rows = [(i, rng.normal(size=8), 0) for i in range(2000)]
    sent, make = [], kd_search.meet

    def meet(k, size, first):
        got = make(k, size, first)

        def run(batches):
            return got(counted(batches))

        def counted(batches):
            for b in batches:
                seen.add(sum(x is None for x in b.column("nodes").to_pylist()))
                yield b
        seen = spark.sparkContext.accumulator(0)
        sent.append(seen)
        return run

    monkeypatch.setattr(kd_search, "meet", meet)
    monkeypatch.setattr(kd_search, "TASKS", 4)
    got = kd_search.top_k(table(spark, rows), every=2, shard=50, queries=100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Join" not in plan
    assert got.count() == 5000
    # 10 blocks (some numbers of blocks may be empty), 40 shards, 4 groups: one group first, then the three others
    first, others = (x.value for x in sent)
    assert 5 <= first <= 10 and others == 3 * first


def kd_forest(v, ids, shards, leaf=16):
    from tidemark.llm.kd_search import Forest, kd_tree, packed
    trees = []
    for n in range(shards):
        mine = np.arange(n, len(v), shards)
        order, nodes, low, high = kd_tree(v[mine], leaf)
        order = mine[order]
        trees.append(dict(zip(("ids", "v", "nodes", "low", "high"),
                              [ids[order].tobytes(), *packed(v[order]), nodes.tobytes(), *packed(low, high)])))
    return Forest(trees, v.shape[1])


@pytest.mark.parametrize("size,kind", [(90, np.float32), (1 << 20, np.float64), (1 << 28, np.int64)])
@pytest.mark.parametrize("kept", [1 << 16, 7])
def test_kd_forest_by_brute_force(monkeypatch, size, kind, kept):
    from tidemark.llm import kd_search
    monkeypatch.setattr(kd_search, "KEPT", kept)
    monkeypatch.setattr(kd_search, "SHARD", 40)  # so wide leaves are read in parts
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.integers(-size, size, (900, 6)), np.tile(rng.integers(-size, size, 6), (300, 1)), np.zeros((60, 6), np.int64)])
    ids = rng.permutation(len(v)).astype(np.int64)
    ids[:20] = ids[20:40]
    forest, some = kd_forest(v, ids, 7), rng.integers(0, len(v), 80)
    q, q_ids = v[some], ids[some]
    want = [sorted((-int(s), int(i)) for s, i in zip(v @ x, ids) if i != own)[:5] for x, own in zip(q, q_ids)]
    kth, kth_id = np.full(80, kd_search.NONE), np.full(80, kd_search.LAST)
    known = np.arange(80) % 3 == 0  # these come with a kth: the fourth best
    kth[known], kth_id[known] = [-w[3][0] for w, x in zip(want, known) if x], [w[3][1] for w, x in zip(want, known) if x]
    rows, found, score = forest.search(5, q_ids, q, kth, kth_id)
    assert forest.kind is kind
    for n in range(80):
        got = list(zip((-score[rows == n]).tolist(), found[rows == n].tolist()))
        assert got == ([w for w in want[n] if w < want[n][3]] if known[n] else want[n])
        assert (-kth[n], kth_id[n]) == want[n][3 if known[n] else 4]


def test_kd_forest_opens_few_leaves_of_clusters():
    from tidemark.llm.kd_search import LAST, NONE
    rng = np.random.default_rng(6)
    v = (40 * rng.normal(size=(64, 1, 16)) + rng.normal(size=(64, 256, 16))).reshape(-1, 16).round().astype(np.int64)
    forest = kd_forest(v, np.arange(len(v)), 2)
    q = np.arange(0, len(v), 50)
    rows, _, score = forest.search(5, q, v[q], np.full(len(q), NONE), np.full(len(q), LAST))
    assert len(rows) == 5 * len(q)
    assert forest.opened < len(q) * len(forest.leaves) / 20


TEXT = ["The first paragraph of an article has quite a few words in it, so that it counts.",
        "A second one follows & mentions <tags> and cafés; it is also long enough to be told from menus.", "Short.",
        "The last one closes the text with a sentence of its own, and nothing else is worth reading here."]


def page(body, head="<title>t</title><style>p{}</style><script>var t='</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


PS = ("<p>The first paragraph of an <b>article</b> has quite\n a few words in it, so that it counts.</p><p>A second one follows &amp; mentions &lt;tags&gt;"
      " and caf&eacute;s; it is also long enough to be told from menus.<p>Short.</p><p>The last one closes the text with a sentence of its own,"
      " and nothing else is worth reading here.")
NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li></ul></nav>'
FOOT = "<footer>&copy; somebody &middot; with a rather long line of words about who may do what with which page of this site.</footer>"


@pytest.mark.parametrize("source", [
    page(f"{NAV}<article>{PS}</article>{FOOT}"),
    page(f"{NAV}<div id=content>{PS}</div>{FOOT}"),
    page(f"<div class='top-nav'><a href=x>one</a> <a href=y>two</a></div><main><div>{PS}</div></main><aside>Buy this now, it is the best thing that was ever sold.</aside>"),
    page(f"<!-- <p>no</p> --><div class=ad>Buy!</div><article>{PS}<div class='comments'><p>I do not like what this page says at all, not one bit.</p></div></article>"),
    page(f"<article>{PS}</article><form>Your name and your address please <input><button>Send</button></form><div role=dialog>We use cookies on this page.</div>"),
    f"<body>{NAV}<article>{PS}",
    page(f"<div style='display: none'>Nobody sees these words on the page.</div><ARTICLE CLASS=\"x>y\">{PS}</ARTICLE>"),
])
def test_main_text(source):
    from tidemark.llm.html_text import main_text
    assert main_text(source).split("\n") == TEXT


def test_articles_beside_each_other():
    from tidemark.llm.html_text import main_text
    other = "<article><p>Another article stands beside the first one and has a sentence of its own.</p></article>"
    links = "<article><a href=/x>Read this next, it is a long title of a page</a></article>"
    got = main_text(page(f"{NAV}<article>{PS}</article>{other}{links}{FOOT}")).split("\n")
    assert got == [*TEXT, "Another article stands beside the first one and has a sentence of its own."]
    nested = main_text(page(f"{NAV}<main><article>{PS}</article>{other}</main>{FOOT}")).split("\n")
    assert nested == got


def test_odd_pages(spark):
    from pyspark.sql import functions as F

    from tidemark.llm.html_text import extract_text, main_text
    deep = "<div>" * 30_000 + "deep words here" + "</div>" * 30_000
    for source in (None, "", "<", "<p", "<a href='x", "<script>", "<!--", "</p></p>", "<p>" * 20_000, "<b>" * 20_000 + "x", "<a '" * 20_000, "&" * 1000, deep):
        assert isinstance(main_text(source), str)
    assert main_text(deep) == "deep words here" and main_text("a  b &amp; c") == "a b & c"
    assert main_text(page("<p>one<br>two</p><ul><li>three<li>four</ul>")) == "one\ntwo\nthree\nfour"
    rows = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "u", page(f"<article>{PS}</article>")), (2, None, "")], "page_id long, url string, html string")
    out = extract_text(rows.withColumn("text", F.lit("x")).withColumn("n_chars", F.lit(1)))
    got = sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in out.collect())
    assert got == [(0, "\n".join(TEXT), len("\n".join(TEXT))), (1, "", 0), (2, "", 0), (2, "", 0)]
    assert extract_text(rows.limit(0)).count() == 0
