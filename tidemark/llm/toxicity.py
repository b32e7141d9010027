"""Toxicity by a weighted finite-state pattern grammar.

A chain of small transducers reads a clause.  The first turns words into classes: insult, threat,
target, negation, reported speech (and quotation marks), or none.  The next ones carry a state
along the clause and mark each insult or threat: in the scope of a negation, inside reported or
quoted speech, aimed at somebody.  A clause is scored by the marks its hits carry, so "you are not
an idiot" and "she said 'idiot'" are other patterns than "you idiot".

Weights are fitted on a bounded sample of labelled texts.  So are the insults: besides the fixed
words, word beginnings that stand in toxic texts far oftener than in clean ones become arcs of the
first transducer.  Nothing but the text goes into a score.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import by_value, released, rest_of, sampled, text_of, written

by_value(__name__)

#: Labelled texts of each class that the model is fitted on, about.
TOXIC_SAMPLE, CLEAN_SAMPLE = 5000, 10000
#: Word beginnings of these lengths may become insults, at most so many.
STEMS, MOST_STEMS = (3, 4, 5, 6, 7, 8), 2000
#: A clause ends at punctuation, or so many characters from its hit.
REACH = 160
#: Words a negation reaches over.
SCOPE = 3
THRESHOLD = 0.3

INSULT = frozenset("""idiot idiots idiotic moron morons moronic stupid dumbass imbecile loser losers scum
 scumbag pathetic worthless disgusting trash garbage vermin clown retard retarded asshole bastard bitch
 freak cretin filth parasite lowlife degenerate""".split())
THREAT = frozenset("""kill murder strangle stab slaughter exterminate lynch behead shoot hurt destroy töten
 umbringen tuer matar""".split())
TARGET = frozenset("""you your yours yourself u he she they him her them his their these those everyone nobody
 du dich dein ihr euch tu vous toi ton votre usted ustedes ellos""".split())
NEGATION = frozenset("""not no never neither nor without isn't aren't wasn't don't doesn't nicht kein keine nie pas
 jamais sin nunca""".split())
REPORT = frozenset("""said says say saying called calls told reported reports wrote writes quoted claims claimed
 accused alleged sagte nannte dit dijo""".split())
QUOTES = frozenset("\"“”«»")
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[\"“”«»]")
END = re.compile(r"[.!?;\n]")

#: A hit is an insult or a threat; aimed, negated, reported or not: 16 patterns, in this order of
#: bits.  Beside their numbers a text has the weight of its strongest arc and its different hits.
PATTERNS = 16
FEATURES = PATTERNS + 2
#: What each is worth before any label is seen: log odds of a single clause.
PRIOR = np.array([2.0 + 1.0 * (k >> 1 & 1) - 1.5 * (k >> 2 & 1) - 1.0 * (k >> 3 & 1)
                  for k in range(PATTERNS)] + [0.5, 0.5])
#: Weight of an arc of the fixed words; learned arcs have their log odds, up to MOST_WEIGHT.
ARC, MOST_WEIGHT = 3.0, 6.0
#: A beginning is an insult if it is so much more frequent in toxic texts, and surely so.
RATIO, SURE = 20.0, 30.0


@dataclass
class Grammar:
    stems: dict[str, float] = field(default_factory=dict)
    words: frozenset = INSULT
    weights: np.ndarray = field(default_factory=lambda: PRIOR.copy())
    bias: float = -4.0


class Reader:
    """The transducers of a grammar, ready to read texts."""

    def __init__(self, grammar: Grammar):
        import ahocorasick
        self.words = grammar.words
        self.net = ahocorasick.Automaton()
        for s, weight in grammar.stems.items():
            self.net.add_word(s, (len(s), False, 0, min(weight, MOST_WEIGHT)))
        for words, kind in ((grammar.words, 0), (THREAT, 1)):
            for w in words:
                self.net.add_word(w, (len(w), True, kind, ARC))
        self.net.make_automaton()

    def hits(self, low: str) -> list[tuple[int, int, int, float]]:
        """(start, end, kind, weight) of words that are an insult or a threat, or begin like one;
        of arcs for one word the strongest."""
        found = []
        for last, (n, whole, kind, weight) in self.net.iter(low):
            a, b = last - n + 1, last + 1
            if (a and low[a - 1].isalpha()) or (whole and b < len(low) and low[b].isalpha()):
                continue
            if not found or found[-1][0] != a:
                found.append((a, b, kind, weight))
            elif weight > found[-1][3]:
                found[-1] = (a, b, kind, weight)
        return found

    def patterns(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, pattern) of each hit of a text."""
        low = text.lower()
        return self.marked(low, self.hits(low))

    def marked(self, low: str, hits) -> list[tuple[int, int, int]]:
        out = []
        for a, b, kind, _ in hits:
            before = END.split(low[max(0, a - REACH):a])[-1]
            after = END.split(low[b:b + REACH], maxsplit=1)[0]
            negated = reported = aimed = False
            scope = quoted = 0
            for w in TOKEN.findall(before):
                # negation: a counter that runs out; speech and aim: states kept to the clause's end
                scope = SCOPE if w in NEGATION else max(0, scope - 1)
                reported |= w in REPORT
                quoted ^= w in QUOTES
                aimed |= w in TARGET
            negated = scope > 0
            aimed |= any(w in TARGET for w in TOKEN.findall(after)[:4])
            out.append((a, b, kind | aimed << 1 | negated << 2 | (reported or bool(quoted)) << 3))
        return out

    def counts(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), FEATURES))
        for i, t in enumerate(texts):
            low = t.lower()
            hits = self.hits(low)
            if hits:
                for _, _, p in self.marked(low, hits):
                    out[i, p] += 1
                out[i, PATTERNS] = 2 ** max(w for *_, w in hits) - 1  # the logarithm is taken later
                out[i, PATTERNS + 1] = len({low[a:b] for a, b, *_ in hits})
        return out


def scores(grammar: Grammar, counts: np.ndarray) -> np.ndarray:
    """Probability of label 1.  The first clause of a pattern counts whole, further ones less."""
    z = np.log2(1 + counts) @ grammar.weights + grammar.bias
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(counts: np.ndarray, toxic: np.ndarray, share: float) -> tuple[np.ndarray, float]:
    """Logistic regression towards PRIOR; the sample is weighed so that ``share`` is toxic."""
    if not len(toxic) or toxic.all() or not toxic.any():
        return PRIOR.copy(), -4.0
    x = np.log2(1 + counts)
    each = np.where(toxic, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
    w, b = PRIOR.copy(), math.log(share / (1 - share))
    m, v = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
    for t in range(1, 801):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        e = each * (p - toxic)
        g = np.append(x.T @ e / len(e) + 1e-4 * (w - PRIOR), e.mean())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def surprise(a, n_a, b, n_b) -> float:
    """Log-likelihood ratio of a of n_a against b of n_b under one common share."""
    both = (a + b) / (n_a + n_b)

    def ll(k, n, p):
        return (k * math.log(p) if k else 0) + ((n - k) * math.log(1 - p) if n > k else 0)

    return 2 * (ll(a, n_a, a / n_a) + ll(b, n_b, b / n_b) - ll(a, n_a, both) - ll(b, n_b, both))


def train(docs: DataFrame, labels: DataFrame, toxic_sample: int = TOXIC_SAMPLE,
          clean_sample: int = CLEAN_SAMPLE) -> Grammar:
    """A grammar from labelled documents whose crc32(doc_id) mod 4 is not 2."""
    known = (labels.filter((rest_of(F.col("doc_id"), 4) != 2) & F.col("toxic").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return Grammar()
    some = (sampled(known.filter("toxic = 1"), toxic_sample, "doc_id")
            .unionByName(sampled(known.filter("toxic = 0"), clean_sample, "doc_id")))
    texts = docs.select("doc_id", text_of().alias("text")).join(some, "doc_id").select("text", "toxic")
    texts = written(texts, "toxic-texts")  # a bounded sample, read three times
    # near copies count once: texts of one class with the same least 3-word shingle
    every = F.expr(r"regexp_extract_all(lower(text), r'\p{L}+', 0)")
    copy = F.coalesce(F.array_min(F.transform(F.sequence(F.lit(0), F.greatest(F.size("all") - 3, F.lit(0))),
                                              lambda i: F.xxhash64(F.slice("all", i + 1, 3)))), F.lit(0))
    starts = F.array_distinct(F.flatten(F.transform(F.array_distinct("all"), lambda w: F.array(
        *[F.when(F.length(w) >= k, F.substring(w, 1, k)) for k in STEMS]))))
    seen = texts.withColumn("all", every).select("toxic", copy.alias("copy"), starts.alias("starts"))
    # a text for each: which of the copies doesn't matter
    seen = written(seen.groupBy("toxic", "copy").agg(F.first("starts").alias("starts")), "toxic-starts")
    total = {r["toxic"]: r["n"] for r in seen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = total.get(1, 0), total.get(0, 0)
    if not pos or not neg:
        return Grammar()
    stems = (seen.select("toxic", F.explode("starts").alias("s")).filter("s is not null").groupBy("s")
             .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
             .filter((F.col("a") >= 5) & (F.col("a") * neg >= RATIO * F.col("b") * pos))
             .orderBy(F.desc("a"), F.length("s"), "s").limit(MOST_STEMS).collect())
    kept: dict[str, float] = {}
    for r in stems:
        s, a, b = r["s"], int(r["a"]), int(r["b"])
        if surprise(a, pos, b, neg) >= SURE and not any(s[:k] in kept for k in STEMS if k < len(s)):
            kept[s] = math.log((a + 0.5) / (pos + 1)) - math.log((b + 0.5) / (neg + 1))
    grammar = Grammar(stems=kept)
    run = counter(grammar)
    rows = texts.mapInArrow(released(run), T.StructType([T.StructField("c", T.BinaryType()), T.StructField("toxic", T.BinaryType())])).collect()
    counts = np.concatenate([np.frombuffer(r["c"], np.float64).reshape(-1, FEATURES) for r in rows])
    toxic = np.concatenate([np.frombuffer(r["toxic"], np.int64) for r in rows])
    grammar.weights, grammar.bias = fit(counts, toxic, n[1] / (n[0] + n[1]))
    return grammar


def counter(grammar: Grammar):
    """Pattern counts of labelled texts, a blob for each batch."""
    def run(batches):
        reader = Reader(grammar)
        for batch in batches:
            c = reader.counts(batch.column("text").to_pylist())
            y = np.array(batch.column("toxic").to_pylist(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (c, y)], ["c", "toxic"])
    return run


def score_toxicity(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """``docs`` with score (0 to 1) and n_hits, the insults and threats found, added.

    Null and empty texts have no clause: they score the base rate of clause-free texts.  Repeated
    rows score alike.  Empty table: empty result.  Other columns stay; score and n_hits of
    ``docs`` give way."""
    out = ["score", "n_hits"]
    keep = [c for c in docs.columns if c not in out]

    def run(batches):
        reader = Reader(grammar)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                c = reader.counts([t or "" for t in batch.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k) for k in keep), pa.array(scores(grammar, c)), pa.array(c[:, :PATTERNS].sum(1).astype(np.int64))],
                    [*keep, *out])

    return docs.select(*keep).mapInArrow(released(run), T.StructType(
        [docs.schema[c] for c in keep] + [T.StructField("score", T.DoubleType()), T.StructField("n_hits", T.LongType())]))
