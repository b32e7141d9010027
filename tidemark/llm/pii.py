"""Personal data by fixed patterns and a skip-chain conditional random field.

Base spans come from fixed patterns.  They and mentions, places that look like an address, a number
or a dotted group, are the nodes of a random field over one document: neighbours in the text share
a chain potential; mentions of the same digits or the same mailbox, however far apart and however
written, share a skip potential; similar ones (the same mailbox name, the last seven digits, the
network of an address) a weaker one.  Loopy message passing spreads labels over all; base spans are
fixed, so their label is never lost, and a mention that the patterns miss takes the label of what it
repeats.

Weights are fitted by pseudo-likelihood on a bounded sample of documents.  A mention that no pattern
matches is an example of no label only if it repeats no base span: else its label is unknown.  And
base spans that repeat another are shown once more with the looks of a mention that no pattern
matches, so that the field learns what a repeat says where the patterns say nothing.  Mentions are
found and labelled in every whole text.  All documents of an Arrow batch make one graph, passed over
at once.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import by_value, released, sampled, text_of

by_value(__name__)

KINDS = ("email", "ip", "card", "phone")
#: Labels of a mention: none, then KINDS.
LABELS = 1 + len(KINDS)
#: Documents with a mention that the weights are fitted on, about.
SAMPLE = 3000
ROUNDS = 12

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a match of the pattern always begins where its first group of digits does
QUAD = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Mentions: unbroken runs around an @, spelt-out addresses, and number-like runs.
MENTION = re.compile(r"(?<![^\s@])[^\s@]++@[^\s@]++|[+(]?[0-9](?:[ ().-]{0,2}[0-9]){6,}")
SPELT = re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}+ ?[\[(]at[\])] ?[\w-]{1,64}+(?: ?(?:\.|[\[(]dot[\])]) ?[\w-]{1,64}+){1,4}", re.I)
CUES = (frozenset(("email", "mail", "e-mail", "contact", "reply")),
        frozenset(("ip", "host", "server", "address", "addr")),
        frozenset(("card", "visa", "mastercard", "credit", "debit")),
        frozenset(("phone", "tel", "call", "fax", "mobile", "cell", "whatsapp")))
N_FEATURES = 24


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order; leftmost and apart for each kind."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            found.append((start, 0, done))
        at = text.find("@", done if m else at + 1)
    for m in QUAD.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(digits_of(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def mentions(text: str) -> list[tuple[int, int]]:
    found = [m.span() for m in MENTION.finditer(text)]
    if any(x in text for x in ("at]", "at)", "AT]", "AT)")):
        found += [m.span() for m in SPELT.finditer(text)]
    trimmed = []
    for a, b in sorted(found):
        while b > a and text[b - 1] in ".,;:!?\"'<>()[]|":
            b -= 1
        while a < b and text[a] in "\"'<>[]|;:,":
            a += 1
        if a < b:
            trimmed.append((a, b))
    return trimmed


def features(text: str, start: int, end: int) -> tuple[list[int], str, str]:
    """The features that hold for a mention, what it repeats if another has the same, and what it is
    similar to if another has the same."""
    s = text[start:end]
    d = digits_of(s) if len(s) < 100 else "0" * 99
    mail = "@" in s or "at]" in s.lower() or "at)" in s.lower()
    on = [0]
    if mail:
        on += [1 if "@" in s else 2]
        if re.search(r"@[\w-]+\.\w", s):
            on += [3]
        parts = re.split(r"@| ?[\[(]at[\])] ?", s.lower(), maxsplit=1)
        key = parts[0].strip("\"'<>(),;:") + "@" + re.sub(r" ?[\[(]dot[\])] ?", ".", parts[-1]).strip(".\"'<>(),;:")
        alike = key.split("@")[0] + "@" if len(key.split("@")[0]) > 4 else ""
    else:
        n = len(d)
        on += [4 + (0 if n < 7 else 1 if n < 10 else 2 if n < 12 else 3 if n < 14 else 4 if n < 16 else
                    5 if n < 17 else 6 if n < 20 else 7)]
        on += [f for f, holds in ((12, s[0] == "+"), (13, 14 <= n <= 19 and luhn(d)), (14, "(" in s),
                                  (15, s.count(".") == 3), (16, "-" in s or " " in s),
                                  (17, start > 0 and text[start - 1].isalnum()),
                                  (18, end < len(text) and text[end].isalpha())) if holds]
        key = d[-10:] if n <= 19 else ""
        alike = s.rpartition(".")[0] + "." if s.count(".") == 3 else d[-7:] if 7 <= n <= 19 else ""
    before = re.findall(r"[a-z-]+|=", text[max(0, start - 24):start].lower())[-2:]
    on += [19 + i for i, words in enumerate(CUES) if not words.isdisjoint(before)]
    if before[-1:] == ["="]:
        on += [23]
    return on, key, alike


def graph(texts: list[str]):
    """The mentions and base spans of many texts as one graph: document, start, end, feature rows,
    fixed label (-1: none), chain, skip and alike edges; and the base spans of each text."""
    doc, start, end, on, fixed, chain, skip, near, base = [], [], [], [], [], [], [], [], []
    for i, text in enumerate(texts):
        spans = base_spans(text)
        base.append(spans)
        last: dict[str, int] = {}
        first, at, places = len(doc), 0, []
        for a, b in mentions(text):
            while at < len(spans) and spans[at][2] <= a:
                at += 1
            over = next((s for s in spans[at:at + len(KINDS)] if s[0] < b and s[2] > a), None)
            places.append((a, b, 1 + over[1] if over else -1))
        # base spans that no mention meets are nodes as well
        met, at = [], 0
        for s in spans:
            while at < len(places) and places[at][1] <= s[0]:
                at += 1
            if not any(a < s[2] and b > s[0] for a, b, _ in places[at:at + 2]):
                met.append((s[0], s[2], 1 + s[1]))
        for a, b, label in sorted(places + met):
            f, key, alike = features(text, a, b)
            n = len(doc)
            doc.append(i), start.append(a), end.append(b), on.append(f), fixed.append(label)
            if n > first:
                chain.append((n - 1, n))
            same = last.get("=" + key) if key else None
            if same is not None:
                skip.append((same, n))
            elif alike and "~" + alike in last:
                near.append((last["~" + alike], n))
            last |= {"=" + key: n} if key else {}
            last |= {"~" + alike: n} if alike else {}
    rows = np.zeros((len(doc), N_FEATURES), np.float64)
    for n, f in enumerate(on):
        rows[n, f] = 1
    pairs = lambda e: np.array(e, np.int64).reshape(-1, 2)
    return doc, start, end, rows, np.array(fixed, np.int64), pairs(chain), pairs(skip), pairs(near), base


def fit(rows: np.ndarray, fixed: np.ndarray, chain: np.ndarray, skip: np.ndarray, near: np.ndarray) -> dict[str, np.ndarray]:
    """Pseudo-likelihood: each mention's label given its features and its neighbours' labels, a
    multinomial regression whose neighbour weights are the edges' potentials.  ``fixed`` has the
    base spans' labels, -1 elsewhere.  Where nothing was seen, a prior holds: like labels attract
    along skip edges, less along alike edges."""
    n = len(fixed)
    unknown = np.zeros(n, bool)  # no base span, but tied to one
    for e in (skip, near):
        for i, j in ((0, 1), (1, 0)):
            unknown[e[(fixed[e[:, i]] < 0) & (fixed[e[:, j]] >= 0), i]] = True
    y = np.eye(LABELS)[np.maximum(fixed, 0)] * ~unknown[:, None]
    around = [np.zeros((n, LABELS)) for _ in range(4)]
    for kind, edges, (i, j) in ((0, chain, (1, 0)), (1, chain, (0, 1)), (2, skip, (1, 0)), (2, skip, (0, 1)),
                                (3, near, (1, 0)), (3, near, (0, 1))):
        np.add.at(around[kind], edges[:, i], y[edges[:, j]])
    x = np.hstack([rows, *around])
    # base spans that repeat one, with the looks of mentions that no pattern matches
    again = np.flatnonzero((fixed > 0) & (around[2][:, 1:].sum(1) > 0))
    plain = np.flatnonzero((fixed < 0) & ~unknown)
    if len(again) and len(plain):
        hidden = x[again]
        hidden[:, :rows.shape[1]] = rows[np.resize(plain, len(again))]
        x, y, unknown = np.vstack([x, hidden]), np.vstack([y, y[again]]), np.append(unknown, np.zeros(len(again), bool))
    x, y = x[~unknown], y[~unknown]
    prior = np.zeros((x.shape[1], LABELS))
    prior[-2 * LABELS:-LABELS] = 4 * np.eye(LABELS)
    prior[-LABELS:] = 0.5 * np.eye(LABELS)
    # to be tied to something without a label says little: it may be missed itself
    prior[[-2 * LABELS, -LABELS]] = 0
    prior[0, 0] = 1  # no label, unless something speaks for one
    w, m, v = prior.copy(), 0, 0
    for t in range(1, 301):
        z = x @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = x.T @ (p - y) / max(1, len(x)) + 1e-3 * (w - prior)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    k = rows.shape[1]
    before, after, same, like = (w[k + i * LABELS:k + (i + 1) * LABELS] for i in range(4))
    return {"node": w[:k], "chain": (before + after.T) / 2, "skip": (same + same.T) / 2, "near": (like + like.T) / 2}


def marginals(model: dict[str, np.ndarray], rows, fixed, chain, skip, near) -> np.ndarray:
    """Loopy sum-product in logarithms, all edges at once, damped."""
    node = rows @ model["node"]
    held = fixed >= 0
    node[held] = -50
    node[held, fixed[held]] = 0
    kinds = (("chain", chain), ("skip", skip), ("near", near))
    edges = np.vstack([e for _, e in kinds])
    force = np.concatenate([np.broadcast_to(model[k], (len(e), LABELS, LABELS)) for k, e in kinds])
    a, b = edges[:, 0], edges[:, 1]
    there, back = np.zeros((len(edges), LABELS)), np.zeros((len(edges), LABELS))
    norm = lambda z: z - np.logaddexp.reduce(z, axis=1)[:, None]

    def belief():
        out = node.copy()
        np.add.at(out, b, there)
        np.add.at(out, a, back)
        return out

    for _ in range(ROUNDS if len(edges) else 0):
        all_ = belief()
        to = norm(np.logaddexp.reduce((all_[a] - back)[:, :, None] + force, axis=1))
        fro = norm(np.logaddexp.reduce((all_[b] - there)[:, None, :] + force, axis=2))
        there, back = (there + to) / 2, (back + fro) / 2
    return np.exp(norm(belief()))


def labelled(texts: list[str], model: dict[str, np.ndarray], least: float = 0.8):
    """For each text: its base spans, and the spans the field adds beside them."""
    doc, start, end, rows, fixed, chain, skip, near, base = graph(texts)
    added: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(doc) and (fixed < 0).any():
        p = marginals(model, rows, fixed, chain, skip, near)
        for n in np.flatnonzero((fixed < 0) & (p[:, 1:].max(1) >= least)):
            mine = added[doc[n]]
            if not mine or mine[-1][2] <= start[n]:
                mine.append((start[n], int(p[n, 1:].argmax()), end[n]))
    return base, added


def train(docs: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """Weights from about ``sample`` documents that have a mention; labels are the base spans'.
    What comes to the driver are the mentions' features."""
    def run(batches):
        for batch in batches:
            _, _, _, rows, fixed, chain, skip, near, _ = graph(batch.column("text").to_pylist())
            blobs = [np.ascontiguousarray(x, np.int64).tobytes() for x in (rows, fixed, chain, skip, near)]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in blobs], list("abcde"))

    some = sampled(docs.select("doc_id", text_of().alias("text"))
                   .filter(F.col("text").rlike(r"@|[0-9][0-9 ().-]{5}")), sample, "doc_id", "text")
    rows, fixed, edges, n = [], [], ([], [], []), 0
    for r in some.select("text").mapInArrow(released(run), "a binary, b binary, c binary, d binary, e binary").collect():
        at = [np.frombuffer(r[c], np.int64) for c in "abcde"]
        rows.append(at[0].reshape(-1, N_FEATURES)), fixed.append(at[1])
        for all_, e in zip(edges, at[2:]):
            all_.append(e.reshape(-1, 2) + n)
        n += len(at[1])
    if not n:
        return fit(np.zeros((0, N_FEATURES)), np.zeros(0, int), *[np.zeros((0, 2), int)] * 3)
    return fit(np.vstack(rows).astype(float), np.concatenate(fixed), *map(np.vstack, edges))


def written_spans(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def find_pii(docs: DataFrame, model: dict[str, np.ndarray] | None = None, sample: int = SAMPLE,
             redact: bool = False) -> DataFrame:
    """One row per row of ``docs``: its columns without text, and n_email, n_ip, n_card, n_phone
    (base spans), base_sha256, spans (all), n_added; with ``redact`` also redacted, the text with
    every span replaced by its kind in square brackets.

    Null or empty text: no spans.  Repeated rows: found in each.  Empty table: empty result.
    Columns of these names in ``docs`` give way to the results."""
    model = model or train(docs, sample)
    out = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"] + ["redacted"] * redact
    keep = [c for c in docs.columns if c not in (*out, "text")]

    def hide(text: str, spans) -> str:
        parts, at = [], 0
        for a, k, b in sorted(spans):
            if b > at:
                parts += [text[at:max(a, at)], f"[{KINDS[k]}]"]
                at = b
        return "".join([*parts, text[at:]])

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                texts = batch.column("text").to_pylist()
                base, added = labelled(texts, model)
                cols = [pa.array([sum(s[1] == k for s in b) for b in base], pa.int64()) for k in range(len(KINDS))]
                cols += [pa.array([hashlib.sha256(written_spans(b).encode()).hexdigest() for b in base], pa.string()),
                         pa.array([written_spans(b + a) for b, a in zip(base, added)], pa.string()),
                         pa.array(map(len, added), pa.int64())]
                if redact:
                    cols.append(pa.array([hide(t, b + a) for t, b, a in zip(texts, base, added)], pa.string()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *cols], [*keep, *out])

    kinds = T.StructType([docs.schema[c] for c in keep] + [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
                         + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
                            T.StructField("n_added", T.LongType())]
                         + [T.StructField("redacted", T.StringType())] * redact)
    return docs.select(*keep, text_of().alias("text")).mapInArrow(released(run), kinds)
