"""Whole jobs: wrapped notices, learning along whole texts, thresholds of stages, deep and named page parts."""

import math
import re

import numpy as np
import pytest

from tests.llm.cases import docs, lower, roots, words

WRAPPED = [
    (1, "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated files", "mit"),
    (2, "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that", "bsd"),
    (3, "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published", "gpl"),
    (4, "one\n" * 50 + "all\nrights\n\nreserved\n" + "two\n" * 90, "all-rights-reserved"),
    (5, "all\n" + "x " * 200 + "\nrights reserved", ""), (6, "Released under the MIT License", "mit"),
    (7, "x " * 40 + "licensed under cc by " + "y " * 15 + "4 0\nz", "cc-by"), (8, "\n \n", ""), (9, None, ""),
]


def test_license_scan_of_wrapped_notices(spark):
    from tidemark.llm.license_join import BLOCK, TEMPLATES, THRESHOLD, license_scan
    split = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    table = docs(spark, [(i, t, "a") for i, t, _ in WRAPPED])
    got = {r["doc_id"]: r for r in license_scan(table, wrapped=True).collect()}
    assert len(got) == len(WRAPPED)
    by_line = {r["doc_id"]: r["labels"] for r in license_scan(table).collect()}
    for i, t, label in WRAPPED:
        found = set()
        for part in [*lower(t or "").split("\n"), lower(t or "")]:
            ws = split.findall(part)
            for k in range(0, len(ws) - BLOCK // 2, BLOCK // 2) if len(ws) > BLOCK else [0]:
                b = set(ws[k:k + BLOCK])
                found |= {x for x, y in TEMPLATES if len(b & set(y.split())) >= math.ceil(THRESHOLD * len(set(y.split())) - 1e-9)}
        assert ",".join(sorted(found)) == got[i]["labels"] and set(filter(None, [label])) <= found, i
    assert [by_line[i] for i in (1, 2, 3, 4)] == [""] * 4
    assert license_scan(table.limit(0), wrapped=True).count() == 0


def test_context_tables_grow_with_the_corpus(spark):
    """Slots follow the contexts in the texts, and tables counted in parts are those counted at once."""
    from tidemark.llm.context_mix import BLOCK, Code, bases, context_odds, contexts, normal, pair_counts, path_of, slots_of, table_bits
    rng = np.random.default_rng(10)
    texts = ["".join(rng.choice(list("abcdefgh  "), 4000)) for _ in range(40)]
    d = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    code = Code(pair_counts(d) * 256 + 1)
    least = (10, 10, 10)
    few, many = table_bits(d.limit(1), code, least), table_bits(d, code, least)
    assert all(a < b for a, b in zip(few[1:], many[1:])) and all(a >= b for a, b in zip(many, least))
    byte, hashes, _ = contexts([normal(t) for t in texts])
    place, length = path_of(byte, code)
    for bits, h in zip(many, hashes):  # as many slots as choices met, or all but as many: it is an estimate
        met = len(np.unique(np.repeat(h, length).astype(np.int64) << 17 | code.node[place]))
        assert 2 ** bits >= 0.7 * met
    d = d.selectExpr("text", "false AS fitted")
    whole = context_odds(d, code, many)[0]
    assert len(whole) == bases(many)[-1] and (whole != 0).sum() > 1000
    assert (context_odds(d, code, many, counted=int(-(-len(whole) // 3 // BLOCK) + 1) * BLOCK)[0] == whole).all()
    assert (slots_of(many[1], hashes[1], length, code.key[place]) < 1 << many[1]).all()


def test_learning_goes_on_to_the_end_of_a_text():
    """Weights, the constant's too, and the map are carried along: plain loops over one text at a time give the same."""
    from tidemark.llm import context_mix as M
    rng = np.random.default_rng(11)
    code = M.Code(rng.integers(1, 1000, (256, 256)))
    odds = rng.integers(-60, 60, M.SLOTS).astype(np.int8)
    weights = rng.uniform(0.1, 0.4, (M.GATES, len(M.ORDERS) + 1)).astype(np.float32)
    texts = [M.normal(" ".join(rng.choice(["one", "two", "three"], n))) for n in (700, 0, 3, 250)]
    assert max(map(len, texts)) > 3 * 512 and M.STEP == 32
    got = M.mixed(texts, code, odds, weights)
    tables, lasts = [odds[a:b] for a, b in zip(M.bases(M.BITS), M.bases(M.BITS)[1:])], []
    for t, bits in zip(texts, got[0]):
        byte, hashes, _ = M.contexts([t])
        w, refine, want = weights.astype(float), M.first_map().astype(float), 0.0
        for a in range(0, len(t), M.STEP):
            place, length = M.path_of(byte[a:a + M.STEP], code)
            x = np.stack([tab[M.slots_of(b, h[a:a + M.STEP], length, code.key[place])] for b, tab, h in zip(M.BITS, tables, hashes)], 1)
            g = code.gate[place] + (x[:, -1] != 0) + (x[:, -2] != 0)
            x = np.concatenate([x * M.ODDS_STEP, np.full((len(x), 1), M.BIAS)], 1)
            y, z = code.turn[place], np.clip((w[g] * x).sum(1), -8, 7.99)
            p, c = 1 / (1 + np.exp(-z)), ((z + 8) * (M.BUCKETS / 16)).astype(int)
            q = np.clip(.6 * p + .4 * refine[c], 1 / 8192, 1 - 1 / 8192)
            want += np.log2(np.where(y, q, 1 - q)).sum()
            np.add.at(w, g, M.RATE * (y - p)[:, None] * x)
            n, ones = np.bincount(c, minlength=M.BUCKETS), np.bincount(c, y, M.BUCKETS)
            refine += M.MAP_RATE * (ones - n * refine) / (1 + M.MAP_RATE * n)
        assert bits == pytest.approx(want, rel=1e-3)
        lasts.append(w)
    assert np.allclose(got[1], np.mean(lasts, 0), atol=2e-3)


def test_fitted_texts_are_counted(spark, monkeypatch):
    """Counts cover all texts; while weights are fitted, the fitted texts' own are off; whole texts are drawn, once each."""
    from tidemark.llm import context_mix as M
    rng = np.random.default_rng(12)
    rows = [(7 if n % 3 == 0 else n, " ".join(rng.choice(["red", "green", "blue", f"n{n}"], 1500)), "a") for n in range(60)]
    rows += [(1, "again and again", "a")] * 30
    d, seen, odds = docs(spark, rows, clash=False), [], []
    mixed, counted = M.mixed, M.context_odds
    monkeypatch.setattr(M, "mixed", lambda texts, code, o, *a: (seen.append(texts), odds.append(o), mixed(texts, code, o, *a))[2])
    model = M.train(d)
    code = M.Code(M.pair_counts(d) * 256 + 1)
    assert (model.odds == counted(d.selectExpr("text", "false AS fitted"), code, model.bits)[0]).all()
    fitted = seen[0]
    assert len(set(fitted)) == len(fitted) > 0 and set(fitted) < {M.normal(t) for _, t, _ in rows}
    assert max(map(len, fitted)) > 4096
    rest = spark.createDataFrame([(t,) for _, t, _ in rows if M.normal(t) not in set(fitted)], "text string")
    assert (odds[-1] == counted(rest.selectExpr("text", "false AS fitted"), code, model.bits)[0]).all()


def test_near_duplicates_stage_takes_five_words_and_four_fifths(spark, tmp_path):
    import corpus_pipeline as P
    from tidemark.llm.ngram_join import jaccard_join
    rng = np.random.default_rng(13)
    vocabulary, rows = [f"w{i}" for i in range(5000)], []
    for n in range(12):
        t = list(rng.choice(vocabulary, 50, replace=False))
        rows.append((n, " ".join(t), "a"))
        rows.append((100 + n, " ".join([*t[:25], "changed", *t[26:]]), "a"))  # between both thresholds
        t[10] = t[20] = t[30] = "other"
        rows.append((200 + n, " ".join(t), "a"))  # below both
    d = docs(spark, rows, clash=False)
    kept = sorted(r["doc_id"] for r in P.near_duplicates(spark, d, str(tmp_path)).collect())
    assert kept == [*range(12), *range(200, 212)]
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (words(t) for _, t, _ in rows)]
    links = [(a, b) for a in range(36) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = [rows[r][0] for r in roots(36, links)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join(d, 5, 80).collect()}
    assert [got[i] for i, _, _ in rows] == want
    assert all(r["doc_id"] == r["component_id"] for r in jaccard_join(d).collect())  # the query's own thresholds


ARTICLE = "The article has a first paragraph of quite a few words, so that it counts as text of the page."


@pytest.mark.parametrize("opened", ["<a href=/{0}>entry {0} ", "<font>entry {0} ", "<b><i>entry {0} "])
def test_end_tags_match_at_any_depth(opened):
    from tidemark.llm.html_text import Page, main_text
    menu = "<nav>" + "".join(opened.format(n) for n in range(400)) + "</nav>"
    assert main_text(f"<body>{menu}<div><p>{ARTICLE}</p></div></body>") == ARTICLE
    assert main_text(f"<body><p>one<p>{'<b>' * 400}two<p>three</body>") == "one\ntwo\nthree"
    tree = Page("<a>x<a>y<div><a>z</div></a>t")
    assert [(t, p) for t, p in zip(tree.tag, tree.parent)] == [("#", -1), ("a", 0), ("a", 0), ("div", 2), ("a", 3)]


def test_named_parts_inside_an_article():
    from tidemark.llm.html_text import main_text
    whole = (f"<div class=article-header><h1 id=social-media>Head line</h1></div><p>{ARTICLE}</p>"
             "<section id=discussion><p>What was found is discussed.</p></section><p class='notice copyright'>Take note of this.</p>")
    want = f"Head line\n{ARTICLE}\nWhat was found is discussed.\nTake note of this."
    gone = ("<div class='post-comments'><p>First!</p></div><div class=related-reading><a href=/1>Another text</a> <a href=/2>One more</a></div>"
            "<div id=sidebar>Buy</div>")
    assert main_text(f"<body><article>{whole}{gone}</article></body>") == want
    assert main_text(f"<body><main>{gone}{whole}</main></body>") == want
    assert main_text(f"<body><div class=header>Top line</div><div><p>{ARTICLE}</p></div><div id=discussion>Talk</div></body>") == ARTICLE


def test_parity_rows_differ_no_more_than_their_sets():
    import numpy as np

    from tidemark.llm.ngram_join import parity
    rng = np.random.default_rng(2)
    for longs in (1, 8, 32):
        for n in (0, 1, 50, 3000):
            x = rng.integers(0, 1 << 63, n).astype(np.uint64)
            y = np.concatenate([x[n // 5:], rng.integers(0, 1 << 63, n // 7 + 1).astype(np.uint64)])
            apart = int(np.bitwise_count((parity(x, longs) ^ parity(y, longs)).view(np.uint64)).sum())
            assert apart <= n // 5 + n // 7 + 1 and len(parity(x, longs)) == longs
    far = [parity(rng.integers(0, 1 << 63, 3000).astype(np.uint64), 32) for _ in range(2)]
    assert np.bitwise_count((far[0] ^ far[1]).view(np.uint64)).sum() > 900


def test_weights_are_fitted_on_all_training_texts(spark):
    """First weights are the mean of those after each training text, long ones and repeats included, by counts of other parts."""
    from tidemark.llm import context_mix as M
    rng = np.random.default_rng(14)
    texts = [M.normal(" ".join(rng.choice(["red", "green", f"n{n}"], 200 + n))) for n in range(30)] + [M.normal("again")] * 5
    code = M.Code(rng.integers(1, 1000, (256, 256)))
    bits, weights = (12, 12, 12), rng.uniform(0.1, 0.4, (M.GATES, len(M.ORDERS) + 1)).astype(np.float32)
    d = spark.createDataFrame([(t.decode(), n % 3) for n, t in enumerate(texts)], "text string, part int").repartition(3)
    odds, *without = M.context_odds(d.withColumnRenamed("part", "fitted"), code, bits, parts=3)
    for p in range(3):
        others = d.where(f"part <> {p}").selectExpr("text", "0 AS fitted")
        assert (without[p] == M.context_odds(others, code, bits)[0]).all() and (without[p] != odds).any()
    got = M.fit_on_all(d, code, without, weights, bits)
    want = np.mean([M.mixed([t], code, without[n % 3], weights, bits)[1] for n, t in enumerate(texts)], 0)
    assert np.allclose(got, want, atol=1e-5) and not np.allclose(got, weights, atol=1e-3)
    assert (M.fit_on_all(d.limit(0), code, without, weights, bits) == weights).all()


def test_train_fits_on_texts_that_are_not_drawn(spark, monkeypatch):
    from tidemark.llm import context_mix as M
    rows = [(n, f"one two three {n}", "a") for n in range(40)]
    fitted = []
    whole = M.fit_on_all
    monkeypatch.setattr(M, "fit_on_all", lambda texts, *a: (fitted.extend(r["text"] for r in texts.collect()), whole(texts, *a))[1])
    M.train(docs(spark, rows, clash=False), sample=1)
    assert sorted(fitted) == sorted(t for _, t, _ in rows)


def test_columns_keep_only_entries_that_may_link(spark, monkeypatch):
    """Documents that share a passage and nothing else are in no column by the time pairs are made; near copies are, and all links stay."""
    from tidemark.llm import ngram_join as N
    rng = np.random.default_rng(21)
    vocabulary, rows = [f"w{i}" for i in range(4000)], []
    passage = [f"p{i}" for i in range(40)]
    blocks = [" ".join(f"b{k}.{i}" for i in range(20)) for k in range(16)]
    for n in range(60):  # two share a passage that nobody else has
        rows.append((n, " ".join([*(f"q{n // 2}.{i}" for i in range(20)), *rng.choice(blocks, 8, replace=False)]), "a"))
    for n in range(6):
        t = [f"g{n}", *passage, *rng.choice(vocabulary, 200 + 300 * n)]
        for k in range(7):
            u = list(t)
            for at in rng.choice(len(u), k * len(u) // 160, replace=False):
                u[at] = f"x{rng.integers(1 << 30)}"
            rows.append((1000 + 10 * n + k, " ".join(u), "a"))
    sets = [{tuple(w[i:i + 3]) for i in range(len(w) - 2)} for w in (words(t) for _, t, _ in rows)]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    held, plain = [], N.stars
    monkeypatch.setattr(N, "stars", lambda own, *a: held.append(own.select("id").collect()) or plain(own, *a))
    got = {r["doc_id"]: r["component_id"] for r in N.jaccard_join(docs(spark, rows, clash=False)).collect()}
    assert [got[i] for i, _, _ in rows] == [rows[r][0] for r in roots(len(rows), links)]
    assert len(links) > 10 and len({x for pair in links for x in pair}) <= len({r["id"] for r in held[0]}) <= 42


def test_near_entries_of_a_column_by_brute_force():
    from tidemark.llm import ngram_join as N
    rng = np.random.default_rng(22)
    many = rng.integers(1, 12, 80)
    first = np.cumsum(many) - many
    n = np.concatenate([np.sort(rng.integers(50, 2000, m)) if k % 2 else np.sort(rng.integers(500, 560, m)) for k, m in enumerate(many)])
    i = (n * rng.uniform(0, 0.1, len(n))).astype(np.int64)
    # columns hold sets that differ in a share of their n-grams
    base = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    sets = [np.concatenate([base[:m - (c := int(m * rng.uniform(0, 0.2)))], rng.integers(0, 1 << 63, c).astype(np.uint64)]) for m in n]
    odd, wide = (np.stack([N.parity(s, w).view(np.uint64) for s in sets]) for w in (8, N.WIDE))
    has = n > N.WIDE_FROM
    got = N.near(first, n, i, odd, wide, has, 90)
    want = np.zeros(len(n), bool)
    for a, m in zip(first, many):
        for x in range(a, a + m):
            for y in range(a, x):
                need = N.least_overlap(int(n[x]), int(n[y]), 90)
                differ = n[x] + n[y] - 2 * need
                rows_ = [odd, wide] if has[x] and has[y] else [odd]
                if (10 * min(n[x], n[y]) >= 9 * max(n[x], n[y]) and min(n[x] - i[x], n[y] - i[y]) >= need
                        and all(np.bitwise_count(r[x] ^ r[y]).sum() <= differ for r in rows_)):
                    want[x] = want[y] = True
    assert (got == want).all() and 0 < want.sum() < len(n)


def test_tasks_give_their_memory_back_at_their_end(monkeypatch):
    from types import SimpleNamespace

    from tidemark.llm import common
    done = []
    monkeypatch.setattr(common.ctypes, "CDLL", lambda _: SimpleNamespace(malloc_trim=done.append))

    def run(batches):
        for b in batches:
            yield 10 // b

    rows = common.released(run)(iter([1, 2, 5]))
    assert next(rows) == 10 and done == [] and list(rows) == [5, 2] and done == [0]
    with pytest.raises(ZeroDivisionError):
        list(common.released(run)(iter([1, 0])))
    assert done == [0, 0]


def test_texts_are_read_once_to_count_contexts(spark):
    """However few slots a task adds up at a time; the counts are those of plain loops."""
    from pyspark.sql import functions as F
    from tidemark.llm import context_mix as M
    rng = np.random.default_rng(31)
    texts = [" ".join(rng.choice(["red", "green", "Blue", f"n{n}", "x" * 90], rng.integers(0, 60))) for n in range(40)]
    reads = spark.sparkContext.accumulator(0)

    def read(t):
        reads.add(1)
        return t

    rows = spark.createDataFrame([(t, n % 3) for n, t in enumerate(texts)], "t string, fitted int").repartition(2)
    d = rows.select(F.udf(read).asNondeterministic()("t").alias("text"), "fitted")
    code, bits = M.Code(rng.integers(1, 1000, (256, 256))), (12, 11, 13)
    odds = M.context_odds(d, code, bits, counted=2 * M.BLOCK, parts=3)
    assert reads.value <= 2 * len(texts)  # their size, then their bytes
    starts = M.bases(bits)
    n = np.zeros((3, starts[-1], 2), np.int64)
    for i, t in enumerate(texts):
        byte, hashes, _ = M.contexts([M.normal(t)])
        place, length = M.path_of(byte, code)
        for k, h in enumerate(hashes):
            np.add.at(n, (i % 3, starts[k] + M.slots_of(bits[k], h, length, code.key[place]), code.turn[place]), 1)
    for got, want in zip(odds, (n.sum(0), *(n.sum(0) - own for own in n))):
        assert (got == M.log_odds(want)).all()


def test_token_hashes_and_weights_alone():
    """Hashes tell tokens apart as words do, in every piece; weights are the same without the score."""
    from tidemark.llm import context_mix as M
    rng = np.random.default_rng(32)
    some = ["one", "eno", "é", "a" * 64, "a" * 65, "b" * 300, "\x00", "\x00\x00"]
    texts = [M.normal(" ".join(some[i] for i in rng.integers(0, len(some), n))) for n in (0, 1, 7, 900, 0, 9000, 30)]
    h, of = M.word_hashes(texts)
    name: dict[int, bytes] = {}
    for i, t in enumerate(texts):
        mine, tokens = h[of == i].tolist(), [*t.split(b" "), M.END] if t != M.END else [M.END]
        tokens = [w.rstrip(b"\n") or M.END for w in tokens]
        assert [name.setdefault(x, w) for x, w in zip(mine, tokens)] == tokens and len(mine) == len(tokens)
    assert len(set(name.values())) == len(name) == len(some) + 1
    code, odds = M.Code(rng.integers(1, 1000, (256, 256))), rng.integers(-60, 60, M.SLOTS).astype(np.int8)
    weights = rng.uniform(0.1, 0.4, (M.GATES, len(M.ORDERS) + 1)).astype(np.float32)
    both = M.mixed(texts, code, odds, weights), M.mixed(texts, code, odds, weights, M.BITS, False)
    assert np.array_equal(both[0][1], both[1][1]) and (both[0][0] < 0).all() and not both[1][0].any()
