"""Operators on texts against brute force, with every odd case in one small table."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.cases import DOCS, LONG, bag, docs, lower, rest, roots, words

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(reversed(d))) % 10 == 0


def plain_spans(t):
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out)


TRICKY = ["a@b.c_d@e.f", "a@b@c.d", "@x.y a@ b", "a@b..c", "1.2.3.4.5", "1.2.3 256.1.1.1 010.001.000.255", "12.34.56.78.", "é@é.é a+b%c@d-e.f-g.",
          "4111-1111 1111-1111", "4111  111111111111", "+1", "+1 ( 23", "+12345678901234567", "+1 (980) 555-6268.", "++49 30 1234567 8", "0" * 16,
          "x@y.z@w.v", "a.b@c.d-", "1.1.1.1@host.org", "5.5.5.5 +5.5.5.5.5.5.5.5.5.5"]


def test_base_spans_are_the_patterns():
    from tidemark.llm.pii import base_spans
    rng = np.random.default_rng(0)
    made = ["".join(rng.choice(list("a1.@+- (5)é9"), 40)) for _ in range(3000)]
    for t in [*TRICKY, *made, *(d[1] or "" for d in DOCS)]:
        assert base_spans(t) == plain_spans(t), t


def test_long_runs_take_linear_time():
    from tidemark.llm.pii import base_spans, mentions
    for t in ("a" * 400_000, "1" * 400_000, "a@" * 100_000, "1." * 200_000, "+1" * 200_000, "(" * 200_000, "1 " * 200_000):
        base_spans(t)
        mentions(t)


def test_pii(spark):
    from tidemark.llm.pii import find_pii
    out = find_pii(docs(spark), redact=True)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == len(DOCS)
    for i, t, _ in DOCS:
        if i is None:
            continue
        spans = plain_spans(t or "")
        assert [rows[i][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[1] == k for s in spans) for k in range(4)]
        text = ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in spans)
        assert rows[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) <= set(rows[i]["spans"].split(","))
    assert "jane.doe" not in rows[10]["redacted"] and "[email]" in rows[10]["redacted"]
    assert rows[1]["spans"] == "" and rows[1]["redacted"] == DOCS[0][1]
    assert find_pii(docs(spark).limit(0)).count() == 0


def test_skip_edges_label_repeats():
    from tidemark.llm.pii import fit, graph, labelled
    texts = [f"call +1 ({n}) 555-{n}8 now. later +1 ({n}) 555-{n}8 again" for n in range(200, 400)]
    texts += [f"order 88{n}12 and total 1234{n} shipped" for n in range(200, 400)]
    _, _, _, rows, fixed, *edges, _ = graph(texts)
    model = fit(rows, fixed, *edges)
    text = "write to +1 (980) 555-6268. " + "words " * 50 + "again 9805556268 today, order 5550001112 too"
    base, added = labelled([text, "order 5550001112 too"], model)
    assert [k for _, k, _ in base[0]] == [3] and [k for _, k, _ in added[0]] == [3]
    assert text[added[0][0][0]:added[0][0][2]] == "9805556268"
    assert added[1] == []


def planted(rng, n):
    """Texts with a base span and, in half of them, a spelling of it that no pattern matches (some of
    the others hold it twice); with numbers and addresses that are nobody's.  Beside each the text
    of the spelling."""
    out = []
    for i in range(n):
        d = "".join(str(x) for x in rng.integers(0, 10, 10))
        who, host = "".join(rng.choice(list("abcdefgh"), 7)), "".join(rng.choice(list("pqrstuv"), 6))
        phone = i % 2 == 0
        base = f"+1 ({d[:3]}) {d[3:6]}-{d[6:]}" if phone else f"{who}@{host}.com"
        odd = f"{d[:3]}-{d[3:6]}-{d[6:]}" if phone else f"{who} [at] {host} [dot] com"
        other = "".join(str(x) for x in rng.integers(0, 10, 10))
        hidden = odd if i % 4 < 2 else ""
        words = " some words of a text " * int(rng.integers(1, 30))
        out.append((f"call or write to {base} now.{words}{hidden or base * (i % 8 > 3)}{words}order {other[:7]} of {other} and {other[:3]}x@ home", hidden))
    return out


def test_the_field_finds_other_spellings():
    from tidemark.llm.pii import fit, graph, labelled
    rng = np.random.default_rng(3)
    seen = planted(rng, 300)
    _, _, _, rows, fixed, *edges, _ = graph([t for t, _ in seen])
    model = fit(rows, fixed, *edges)
    fresh = planted(rng, 200)
    base, added = labelled([t for t, _ in fresh], model)
    hits = [(t[a:b], h) for (t, h), spans in zip(fresh, added) for a, _, b in spans]
    right = sum(found == h for found, h in hits)
    assert right / max(1, len(hits)) > .98 and right / sum(bool(h) for _, h in fresh) > .95
    text = "mail jane.doe@example.com, then jane.doe [at] example [dot] com, ip 10.0.0.1 and 10.0.0.1"
    (spans,), (more,) = labelled([text], model)
    assert [text[a:b] for a, _, b in more] == ["jane.doe [at] example [dot] com"] and [k for _, k, _ in spans] == [0, 1, 1]


def test_short_base_spans_are_nodes():
    from tidemark.llm.pii import graph
    _, start, _, _, fixed, chain, skip, near, base = graph(["8.8.8.8 here, 8.8.8.8 there, 8.8.8.9 too", "", "1.2.3.4"])
    assert fixed.tolist() == [2] * 4 and len(base[0]) == 3 and start == [0, 14, 29, 0]
    assert chain.tolist() == [[0, 1], [1, 2]] and skip.tolist() == [[0, 1]] and near.tolist() == [[1, 2]]


def test_messages_are_exact_on_trees():
    import itertools

    from tidemark.llm.pii import LABELS, marginals
    rng = np.random.default_rng(1)
    model = {"node": rng.normal(size=(3, LABELS))} | {k: (m + m.T) / 2 for k in ("chain", "skip", "near")
                                                       for m in [rng.normal(size=(LABELS, LABELS))]}
    rows, fixed = rng.normal(size=(5, 3)), np.array([-1, 3, -1, -1, -1])
    edges = {"chain": np.array([[0, 1], [1, 2]]), "skip": np.array([[1, 3]]), "near": np.array([[2, 4]])}
    total = np.zeros((5, LABELS))
    for labels in itertools.product(range(LABELS), repeat=5):
        if labels[1] == 3:
            score = sum(rows[n] @ model["node"][:, labels[n]] for n in (0, 2, 3, 4))
            score += sum(model[k][labels[a], labels[b]] for k, e in edges.items() for a, b in e)
            for n in range(5):
                total[n, labels[n]] += np.exp(score)
    got = marginals(model, rows, fixed, edges["chain"], edges["skip"], edges["near"])
    assert np.abs(got - total / total.sum(1, keepdims=True)).max() < 1e-2


def test_toxicity(spark):
    from tidemark.llm.toxicity import score_toxicity, train
    rng = np.random.default_rng(1)
    said = lambda n: " ".join(rng.choice(["haus", "baum", "weg", "licht", "stein", "wald"], n))
    rows = [(i, f"{said(20)} {['zorkelu', 'zorkant', 'you idiot'][i % 3]} {said(9)}" if i % 4 == 0 else said(30), "a") for i in range(1200)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(1200)] + [(0, 1, 1), (99999, 1, None)], "doc_id long, quality int, toxic int")
    d = docs(spark, rows + DOCS)
    grammar = train(d, labels)
    assert any("zorkelu".startswith(s) for s in grammar.stems) and not any("baum".startswith(s) for s in grammar.stems)
    got = score_toxicity(d, grammar).select("doc_id", "text", "score").collect()
    assert len(got) == len(rows) + len(DOCS)
    for r in got:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] is not None and r["text"] in {t for _, t, _ in rows}:
            assert (r["score"] >= 0.3) == any(w in r["text"] for w in ("zork", "idiot"))
    assert score_toxicity(d.limit(0), grammar).count() == 0
    assert train(d, labels.limit(0)).stems == {}


def test_clause_patterns():
    from tidemark.llm.toxicity import Grammar, Reader
    read = Reader(Grammar()).patterns
    kinds = lambda t: [p for _, _, p in read(t)]
    assert kinds("you idiot") == [0b0010]
    assert kinds("they are not an idiot.") == [0b0110]
    assert kinds("she said idiot") == [0b1010]
    assert kinds('"idiot" was written') == [0b1000]
    assert kinds("not so. idiot") == [0] and kinds("idiotproof idioten") == []
    assert kinds("i will kill you") == [0b0011]
    assert kinds("") == []


def test_license_scan(spark):
    from tidemark.llm.license_join import BLOCK, PHRASES, TEMPLATES, THRESHOLD, license_scan
    rows = DOCS + [(20, "word " * 100 + "under the MIT license under the mit license cc by-nc apache license, version 2 " + "word " * 70, "a"),
                   (21, "All rights reserved", "a"), (22, "all\nrights reserved", "a"), (23, "x " * 63 + "licensed under cc by nc 4 0 " + "the " * 40, "b"),
                   (24, "cc by nc cc by nc", "b")]
    split = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in license_scan(docs(spark, rows)).collect():
        if r["doc_id"] is None:
            continue
        text = lower(next(t for i, t, _ in rows if i == r["doc_id"]) or "")
        ws = split.findall(text)
        places, base = [], set()
        for phrase, label in PHRASES:
            p = phrase.split()
            at = [i for i in range(len(ws)) if ws[i:i + len(p)] == p]
            places += at
            base |= {label} if at else set()
        found, best = set(), 0.0
        for line in text.split("\n"):
            lw = split.findall(line)
            for i in range(0, len(lw) - BLOCK // 2, BLOCK // 2) if len(lw) > BLOCK else [0]:
                b = set(lw[i:i + BLOCK])
                for label, t in TEMPLATES:
                    t = set(t.split())
                    if len(b & t) >= math.ceil(THRESHOLD * len(t) - 1e-9):
                        found.add(label)
                        best = max(best, len(b & t) / len(t))
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (
            len(ws), len(places), min(places, default=None), max(places, default=None)), r
        assert r["base_labels"] == ",".join(sorted(base)) and r["labels"] == ",".join(sorted(base | found))
        assert r["score"] == pytest.approx(1.0 if places else best)
    assert license_scan(docs(spark).limit(0)).count() == 0
    assert license_scan(docs(spark)).count() == len(DOCS)


def test_fair_mix(spark):
    from tidemark.llm.fair_mix import fair_mix
    rng = np.random.default_rng(2)
    rows = DOCS + [(100 + i, "w " * int(rng.integers(0, 60)), ["a", "b", "ü", "Z", None][min(4, i % 7)]) for i in range(600)]
    rows += [(5000 + i, "same text here", "tiny") for i in range(3)]
    got = fair_mix(docs(spark, rows), carry=("text",)).collect()
    assert len(got) == len(rows)
    total, sizes = 0, Counter()
    for i, t, s in rows:
        total += len(words(t))
        sizes[s] += len(words(t))
    assert sum(r["size"] for r in got) == total >= sum(r["taken"] for r in got)
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    capped, left = {}, total
    while True:  # the excess goes round until none is above
        free = {s: w for s, w in weight.items() if s not in capped}
        share = {s: (total - sum(capped.values())) * w / sum(free.values()) for s, w in free.items()}
        over = {s: 3.0 * sizes[s] for s in share if share[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    target, taken = share | capped, Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(len(words(t)) for _, t, x in rows if x == s)
    again = fair_mix(docs(spark, rows[::-1]).repartition(7))
    assert bag(again, "doc_id", "taken") == sorted(
        ((r["doc_id"], r["taken"]) for r in got), key=lambda t: [(x is not None, str(type(x)), x) for x in t])
    assert fair_mix(docs(spark).limit(0)).count() == 0
    assert {r["taken"] for r in fair_mix(docs(spark, [(1, "", "a"), (2, None, None)])).collect()} == {0}


def test_pack(spark):
    from tokenizers import Tokenizer

    from tidemark.llm.packing import pack
    from tidemark.llm.queries import word_tokenizer
    tok = Tokenizer.from_file(word_tokenizer())
    got = pack(docs(spark), word_tokenizer(), keep_ids=True).collect()
    want = []
    for i, t, _ in DOCS:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            p = ids[k:k + 2048]
            want.append((i if i is not None else -1, k // 2048, k, len(p), zlib.crc32(np.array(p, "<u4").tobytes()), p))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["piece"], r["start"], r["length"], r["ids_crc32"], r["ids"]) for r in got) == sorted(want)
    full: dict = {}
    for r in got:
        full.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in full.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
    assert pack(docs(spark).limit(0), word_tokenizer()).count() == 0


def test_plan_uses_exact_sums():
    from tidemark.llm.packing import plan
    rng = np.random.default_rng(3)
    for count in ({2048: 3, 2047: 5, 1: 5}, {1000: 2, 1048: 2}, {700: 1, 648: 1}, {1024: 7}, {683: 2, 682: 1}, {1500: 4, 300: 4, 200: 4, 48: 4}, {},
                  {int(x): int(n) for x, n in zip(rng.integers(1, 2049, 400), rng.integers(1, 50, 400))}):
        used, seqs = Counter(), 0
        for times, items in plan(count):
            assert times > 0 and sum(x * k for x, k in items) <= 2048
            seqs += times
            for x, k in items:
                used[x] += times * k
        assert used == Counter(count)
        # no two pieces over half a sequence share one
        least = max(sum(x * n for x, n in count.items()) / 2048, sum(n for x, n in count.items() if x > 1024))
        assert seqs <= 1.02 * least + 1.5
    assert plan({1500: 4, 300: 4, 248: 4}) == [(4, [(1500, 1), (300, 1), (248, 1)])]


def test_jaccard_join(spark):
    from tidemark.llm.ngram_join import jaccard_join
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, base = list(DOCS), [list(rng.choice(vocabulary, 150)) for _ in range(12)]
    for n in range(200):
        t = list(base[n % 12])
        for _ in range(int(rng.integers(0, 4))):
            t[int(rng.integers(len(t)))] = f"x{rng.integers(99)}"
        rows.append((100 + n, " ".join(["Common passage of all these documents"] * (n % 3 == 0) + t), "a"))
    rows += [(900 + n, "chain " + " ".join(f"c{k}" for k in range(n, n + 100)), "b") for n in range(12)]
    sets = []
    for _, t, _ in rows:
        ws = words(t)
        sets.append({tuple(ws[i:i + 3]) for i in range(max(1, len(ws) - 2))} if ws else set())
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    root, least = roots(len(rows), links), {}
    for i, r in enumerate(root):
        if rows[i][0] is not None:
            least[r] = min(least.get(r, 1 << 60), rows[i][0])
    want = [(rows[i][0], len(sets[i]), least.get(root[i])) for i in range(len(rows))]
    got = jaccard_join(docs(spark, rows))
    assert len(set(want)) > 50
    assert bag(got, "doc_id", "n_shingles", "component_id") == sorted(want, key=lambda t: [(x is not None, str(type(x)), x) for x in t])
    assert jaccard_join(docs(spark).limit(0)).count() == 0


def test_repeated_columns_across_batches(spark):
    from tidemark.llm.ngram_join import repeated
    rng = np.random.default_rng(8)
    rows = [(int(g), i, 0) for i, g in enumerate(rng.integers(0, 400, 500))]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for size in ("1", "2", "7", "10000"):
            spark.conf.set(key, size)
            got = repeated(spark.createDataFrame(rows, "gram long, id long, i int").repartition(3)).collect()
            often = Counter(g for g, _, _ in rows)
            assert sorted(map(tuple, got)) == sorted(r for r in rows if often[r[0]] > 1)
    finally:
        spark.conf.set(key, before)


def test_context_mix(spark):
    from tidemark.llm.context_mix import score_texts
    rng = np.random.default_rng(5)
    rows = DOCS + [(100 + n, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"], 40)), "a") for n in range(150)]
    rows += [(900, " ".join(rng.choice(list("qxzjvkw"), 120)), "a")]
    got = score_texts(docs(spark, rows), head=3).collect()
    assert len(got) == len(rows)
    count = Counter()
    for i, t, _ in rows:
        if rest(i, 7) != 2:
            count.update([*words(t), "\n"])
    n, v = sum(count.values()), len(count)
    base = lambda t: sum(math.log10((count[w] + 1) / (n + 1 * (v + 1))) for w in [*words(t), "\n"])
    text = {i: t for i, t, _ in rows}
    per_byte = {}
    for r in got:
        t = text[r["doc_id"]]
        assert r["held_out"] == (rest(r["doc_id"], 7) == 2) and r["train_tokens"] == n
        if r["doc_id"] is not None:
            assert r["n_tokens"] == len(words(t)) + 1 and r["n_known"] == sum(count[w] > 0 for w in [*words(t), "\n"])
            assert r["base_score"] == pytest.approx(base(t))
            per_byte[r["doc_id"]] = r["bits_per_byte"]
        assert r["score"] <= 0
    seen = [per_byte[100 + k] for k in range(150) if rest(100 + k, 7) == 2]
    assert max(seen) < 1.0 < per_byte[900]
    assert score_texts(docs(spark).limit(0)).count() == 0


def test_choices_make_a_probability():
    """Over all next bytes, the code's choices sum to one: a byte's bits are a path to one leaf."""
    from tidemark.llm.context_mix import Code
    code = Code(np.random.default_rng(9).integers(1, 10 ** 6, (256, 256)) ** 3)
    for other in (0, 32, 97, 255):
        length, first = (x[256 * other:256 * other + 256] for x in (code.length, code.first))
        assert sum(2.0 ** -int(n) for n in length) == 1.0
        at = [slice(a, a + n) for a, n in zip(first, length)]
        assert len({tuple(zip(code.node[s].tolist(), code.turn[s].tolist())) for s in at}) == 256


def test_score_does_not_depend_on_the_batch():
    from tidemark.llm.context_mix import GATES, ORDERS, SLOTS, Code, Model
    rng = np.random.default_rng(6)
    model = Model(Code(np.ones((256, 256), np.int64)), rng.integers(-99, 99, SLOTS).astype(np.int8),
                  np.full((GATES, len(ORDERS)), 0.3, np.float32))
    texts = ["abc def", "", LONG[:5000], "äöü", "abc def"]
    together = model.score(texts)[0]
    alone = np.array([model.score([t])[0][0] for t in texts])
    assert np.allclose(together, alone, rtol=1e-6) and together[0] == together[4]


def test_columns_of_the_same_documents_are_one(spark, monkeypatch):
    from tidemark.llm import ngram_join
    rng = np.random.default_rng(9)
    members = [tuple(sorted(rng.choice(60, rng.integers(1, 12), replace=False).tolist())) for _ in range(25)]
    rows = [(g, d, 0) for g in range(200) for d in members[g % 25]] + [(900 + g, d, 0) for g in range(2) for d in range(3000)]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    monkeypatch.setattr(ngram_join, "HELD", 500)
    try:
        for size in ("3", "10000"):
            spark.conf.set(key, size)
            got: dict[int, list[int]] = {}
            for r in ngram_join.repeated(spark.createDataFrame(rows, "gram long, id long, i int"), by_documents=True).collect():
                got.setdefault(r["gram"], []).append(r["id"])
            small = Counter(tuple(sorted(ids)) for ids in got.values() if len(ids) < 3000 and len(set(ids)) < 100)
            # each set of documents has one column, with a row for each column that it stands for
            want = Counter(tuple(sorted(d for d in m for _ in range(8 * members.count(m)))) for m in set(members) if len(m) > 1)
            assert small == want
            hot = [ids for ids in got.values() if len(set(ids)) >= 100]  # one, or one each where they are too long to hold
            assert sorted(d for ids in hot for d in ids) == sorted(2 * list(range(3000)))
            assert all(set(ids) == set(range(3000)) for ids in hot)
    finally:
        spark.conf.set(key, before)


def test_more_links_of_two_components_are_one(spark, monkeypatch):
    from tidemark.llm import ngram_join
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    parts = ngram_join.joined(None, frame([(i, i - 1) for i in range(1, 30)] + [(i, i - 1) for i in range(101, 130)]))
    seen, plain = [], ngram_join.components
    monkeypatch.setattr(ngram_join, "components", lambda links: seen.append(links.count()) or plain(links))
    cross = [(i, 100 + j) for i in range(30) for j in range(30)] + [(200, 129), (300, 301), (5, 6)]
    got = {r["v"]: r["root"] for r in ngram_join.joined(parts, frame(cross)).collect()}
    assert seen == [3]  # 0 - 100, 200 - 100, 300 - 301
    assert got == {**{v: 0 for v in [*range(30), *range(100, 130), 200]}, 300: 300, 301: 300}


def test_encoder_gives_the_tokenizer_s_ids(monkeypatch):
    import tokenizers

    from tidemark.llm import packing
    from tidemark.llm.queries import word_tokenizer
    monkeypatch.setattr(packing, "KEPT", 20_000)
    tokenizers.__dict__.pop("_loaded", None)
    rng = np.random.default_rng(10)
    letters = list("abcdefghijklmnopqrstuvwxyzABCXYZ\u00e9\u00df\u00c9\u00f1\u0130\u03a3\u03c3\u03c2\u0416\u01c5\u0301\u4e2d\u1e9e")
    words = ["".join(rng.choice(letters, rng.integers(1, 9))) for _ in range(3000)]
    behind = ["", ".", ",", "...", "%%%", "!?", "'s", "'", "<|", "3", "-a", "\u2026", ".\u0301", "<|endoftext|>", "\x00", "\u00a0x"]
    texts = [" ".join(w + str(rng.choice(behind)) for w in rng.choice(words, 40)) for _ in range(200)]
    texts += ["", " ", "x" * 1000, "\u00e9" * 300 + ".", "Don't <|endoftext|> STOP.", ". , %%%"]
    tok = tokenizers.Tokenizer.from_file(word_tokenizer())
    try:
        encode = packing.encoder(word_tokenizer())
        for t, ids in zip(texts, encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t
        # the store stays bounded within a call, too
        assert tokenizers._loaded[word_tokenizer()].held < 25_000
    finally:
        tokenizers.__dict__.pop("_loaded", None)


def test_few_texts_are_taken_out_of_a_batch_at_once():
    import pyarrow as pa

    from tidemark.llm.ngram_join import AT_ONCE, sliced
    batches = [pa.RecordBatch.from_arrays([pa.array(range(n))], ["i"]) for n in (0, 3, 2 * AT_ONCE + 7)]
    got = list(sliced(batches))
    assert [b.num_rows for b in got] == [3, AT_ONCE, AT_ONCE, 7]
    assert [i for b in got for i in b.column("i").to_pylist()] == [*range(3), *range(2 * AT_ONCE + 7)]
