"""Language identification by string kernels.

A text is the set of its character n-grams of 1 to 3 letters (the blended spectrum, by presence):
lower case, every run of other characters one space, a space at both ends.  Two texts' kernel is
the size of the intersection over the root of the product of the sizes.  A bounded sample of
labelled texts, the same number for each language, is fitted: Nystroem features from the kernel
with landmark texts, then one ridge regression per language (one against the rest), its penalty
chosen by leave-one-out error.

Landmarks and weights fold into one matrix of n-grams by languages, so a batch of texts is scored
by one product of its sparse presence matrix with it.  n-grams are exact: three code points make
63 bits.  What is broadcast has a bound: the n-grams of ``LANDMARKS`` texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import by_value, rest_of, text_of, written

by_value(__name__)

#: Labelled texts that the model is fitted on, at most; each language has an equal part.
FIT_ROWS = 4096
#: Landmark texts among them, at most.
LANDMARKS = 256
#: Longer texts aren't drawn for the fit (they are scored whole, like all).
FIT_CHARS = 1 << 18
#: Characters looked at together.
PIECE = 1 << 20
PENALTIES = 10.0 ** np.arange(-5, 3)


def letters_of(codes: np.ndarray) -> np.ndarray:
    """Code points with everything but letters as spaces."""
    out = np.where((codes >= 97) & (codes <= 122), codes, 32)
    for c in np.unique(codes[codes > 127]):
        if chr(c).isalpha():
            out[codes == c] = c
    return out


def spectrum(text: str | None) -> np.ndarray:
    """The set of a text's n-grams of 1 to 3 characters as sorted numbers; empty without letters."""
    found, carry = [], np.array([32], np.int64)
    text = text or ""
    for at in range(0, len(text), PIECE):
        last = at + PIECE >= len(text)
        codes = np.frombuffer(text[at:at + PIECE].lower().encode("utf-32-le", "replace"), "<u4").astype(np.int64)
        run = np.concatenate([carry, letters_of(codes), np.full(int(last), 32)])
        run = run[np.concatenate([[True], (run[1:] != 32) | (run[:-1] != 32)])]
        carry = run[-2:]
        two = run[:-1] << 21 | run[1:]
        found.append(np.unique(np.concatenate([run, two, two[:-1] << 21 | run[2:]])))
    grams = np.unique(np.concatenate(found)) if len(found) > 1 else found[0] if found else np.zeros(0, np.int64)
    return grams if len(grams) > 1 and (grams[grams < 1 << 21] != 32).any() else np.zeros(0, np.int64)


def presence(texts: list, vocabulary: np.ndarray):
    """The sparse presence matrix of a batch (row, column of every known n-gram) and set sizes."""
    rows, columns, sizes = [], [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        grams = spectrum(t)
        sizes[i] = len(grams)
        if len(grams) and len(vocabulary):
            at = np.minimum(np.searchsorted(vocabulary, grams), len(vocabulary) - 1)
            at = at[vocabulary[at] == grams]
            columns.append(at)
            rows.append(np.full(len(at), i))
    return (np.concatenate(rows) if rows else np.zeros(0, np.int64),
            np.concatenate(columns) if columns else np.zeros(0, np.int64), sizes)


def product(rows: np.ndarray, columns: np.ndarray, matrix: np.ndarray, n: int) -> np.ndarray:
    """Sparse 0/1 matrix with ``n`` rows times a dense one."""
    return np.stack([np.bincount(rows, matrix[columns, c], n) for c in range(matrix.shape[1])], 1)


@dataclass
class Landmarks:
    """Texts' n-grams, from n-gram to texts: texts of vocabulary[g] are who[start[g]:start[g + 1]]."""

    vocabulary: np.ndarray
    start: np.ndarray
    who: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def of(texts: list) -> "Landmarks":
        sets = [spectrum(t) for t in texts]
        grams = np.concatenate([*sets, np.zeros(0, np.int64)])
        who = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(grams, kind="stable")
        vocabulary, start = np.unique(grams[order], return_index=True)
        return Landmarks(vocabulary, np.append(start, len(grams)), who[order].astype(np.int32),
                         np.array([len(s) for s in sets]))

    def kernel(self, texts: list) -> np.ndarray:
        """Kernels of texts (rows) with the landmarks (columns)."""
        out = np.zeros((len(texts), len(self.sizes)))
        for i, t in enumerate(texts):
            _, columns, (size,) = presence([t], self.vocabulary)
            first, upto = self.start[columns], self.start[columns + 1]
            n = upto - first
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
            out[i] = np.bincount(self.who[at], minlength=len(self.sizes)) / np.sqrt(np.maximum(1, size * self.sizes))
        return out


@dataclass
class Model:
    languages: list
    vocabulary: np.ndarray
    weights: np.ndarray  # n-grams by languages
    bias: np.ndarray

    def margins(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Margins (texts by languages) and whether a text has a letter."""
        rows, columns, sizes = presence(texts, self.vocabulary)
        dots = product(rows, columns, self.weights, len(texts))
        return dots / np.sqrt(np.maximum(1, sizes))[:, None] + self.bias, sizes > 0


def ridge(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of y (-1, 1; a column per language) on z, by the penalty of the least
    squared leave-one-out error."""
    mean, level = z.mean(0), y.mean(0)
    u, s, vt = np.linalg.svd(z - mean, full_matrices=False)
    uy = u.T @ (y - level)
    best = None
    for penalty in PENALTIES:
        shrink = s * s / (s * s + penalty)
        fitted = level + u @ (shrink[:, None] * uy)
        leverage = (u * u) @ shrink + 1 / len(z)
        error = (((y - fitted) / np.maximum(1e-6, 1 - leverage)[:, None]) ** 2).sum()
        if best is None or error < best[0]:
            best = error, vt.T @ ((s / (s * s + penalty))[:, None] * uy)
    return best[1], level - mean @ best[1]


def fit_sample(labelled: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` different (lang, text) rows of ``labelled``, for each language the same
    number as far as it has them, chosen by a hash: lang, place (1 is the first of its language),
    text.  Copies of a text count once, so a text that very many rows hold is one row."""
    docs = labelled.select("lang", "text").withColumn("h", F.xxhash64("text", "lang"))
    keys = docs.select("lang", "h").distinct()
    sizes = keys.groupBy("lang").agg(F.count("*").alias("n"))
    # about twice each language's part, so that the first of a language, by hash, are there
    part = sizes.agg((F.lit(2.0 * bound) / F.greatest(F.lit(1), F.count("*"))).alias("part")).scalar()
    near = keys.join(sizes, "lang").filter(
        F.pmod(F.xxhash64("h"), F.lit(1 << 30)) < part / F.col("n") * (1 << 30) + (1 << 10))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("h"), "h"))
    chosen = near.withColumn("place", place).orderBy("place", "lang").limit(bound).select("lang", "h", "place")
    texts = docs.join(F.broadcast(chosen), ["lang", "h"])  # at most ``bound`` rows
    return texts.groupBy("lang", "place").agg(F.min("text").alias("text"))


def train(docs: DataFrame, rows: int = FIT_ROWS, landmarks: int = LANDMARKS) -> Model | None:
    """A model from the labelled rows of ``docs`` (text, lang); None where there are none."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (F.length("text") <= FIT_CHARS))
    sample = written(fit_sample(usable, rows), "language-sample")
    # at most ``landmarks`` texts of at most FIT_CHARS characters
    marks = Landmarks.of([r["text"] for r in sample.orderBy("place", "lang").limit(landmarks).collect()])

    def kernels(batches):
        for batch in batches:
            k = marks.kernel(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("place"), pa.array(list(k), pa.list_(pa.float64()))], ["lang", "place", "k"])

    # at most ``rows`` times ``landmarks`` numbers
    found = sample.select("lang", "place", "text").mapInArrow(kernels, "lang string, place int, k array<double>").toPandas()
    if not len(found):
        return None
    found = found.sort_values(["lang", "place"])
    languages = sorted(set(found["lang"]))
    own = np.zeros((len(marks.sizes), len(marks.sizes)))
    for g in range(len(marks.vocabulary)):
        w = marks.who[marks.start[g]:marks.start[g + 1]]
        own[np.ix_(w, w)] += 1
    own /= np.sqrt(np.outer(marks.sizes, marks.sizes))
    spread, axes = np.linalg.eigh(own)
    fine = spread > 1e-9 * spread[-1]
    whiten = axes[:, fine] / np.sqrt(spread[fine])
    z = np.stack(found["k"]) @ whiten
    y = np.where(found["lang"].to_numpy()[:, None] == np.array(languages, object)[None, :], 1.0, -1.0)
    weights, bias = ridge(z, y)
    by_mark = (whiten @ weights) / np.sqrt(marks.sizes)[:, None]
    folded = np.add.reduceat(by_mark[marks.who], marks.start[:-1], 0)
    return Model(languages, marks.vocabulary, folded, bias)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """The columns of ``docs`` (with a column text), then lang_pred and score (0 to 1: the winning
    language's margin, moved from -1..1).  Null text or no letter, or no model: ``und``, 0.
    Texts of any length are read whole, piece by piece.  Ties go to the first language by name.
    Columns named like the two new ones are replaced."""
    docs = docs.drop("lang_pred", "score")
    names, kept = docs.columns, [f"c{i}" for i in range(len(docs.columns))]
    parts = () if model is None else (model.languages, model.vocabulary, model.weights, model.bias)

    def run(batches):
        scorer = Model(*parts) if parts else None
        for batch in batches:
            texts, lang, score = batch.column("the_text").to_pylist(), [], []
            for at in range(0, len(texts), 256):
                some = texts[at:at + 256]
                margins, known = scorer.margins(some) if scorer else (np.zeros((len(some), 1)), np.zeros(len(some), bool))
                best = margins.argmax(1)
                value = np.clip((1 + margins[np.arange(len(some)), best]) / 2, 0, 1)
                lang += [scorer.languages[b] if k else "und" for b, k in zip(best, known)]
                score += [float(v) if k else 0.0 for v, k in zip(value, known)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             [*kept, "lang_pred", "score"])

    kinds = [f"{c} {docs.schema[n].dataType.simpleString()}" for c, n in zip(kept, names)]
    given = docs.select(*[F.col(n).alias(c) for n, c in zip(names, kept)], text_of().alias("the_text"))
    return given.mapInArrow(run, ", ".join([*kinds, "lang_pred string", "score double"])).toDF(*names, "lang_pred", "score")


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs`` (doc_id, text, lang): learned
    from rows whose crc32(doc_id) mod 4 is not 2.  Null doc_id counts as the empty text there and
    is kept; repeated rows are rows of their own.  Empty table: empty result."""
    held = rest_of(F.col("doc_id"), 4) == 2
    model = train(docs.filter(~held).select("text", "lang"))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")
