"""Hard negatives by rotated one-bit codes with stored alignment.

Rows lie in cells around centres fitted on a bounded sample.  A row's difference from its centre
is rotated at random and kept as one sign bit a dimension, with its length and its alignment: the
cosine between the rotated difference and its sign vector.  An anchor's difference from the same
centre, in whole steps, meets the signs by popcounts over its bit planes.  What the code doesn't
hold is orthogonal to the sign vector, so Cauchy-Schwarz bounds it by the anchor's part that is
orthogonal too: a deterministic interval around every score, which holds the score for certain.
Rows whose interval can't matter are left out; the others are scored in whole numbers.

Anchors meet rows in blocks: a cell in parts of bounded size, by chunks of anchors of bounded size.
An anchor goes only to blocks that may hold what it looks for: first to its own block, for a lower
bound of its last positive, then to blocks whose centre and radius don't rule out better ones.
A block returns at most ``positives`` (or ``negatives``) rows for an anchor, so nothing grows with
the pairs looked at; no partner is capped before the exact score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import by_value, sampled, written
from tidemark.llm.subspace_join import sound
from tidemark.llm.whitening import matrix_of

by_value(__name__)

#: Centres, and rows they and the largest cells are fitted on, about.
CELLS, SAMPLE = 32, 4096
#: Rows of a part of a cell, and anchors of a chunk, about; fewer rows where vectors are longer than WIDE.
PART, CHUNK, WIDE = 8192, 4096, 128
#: Bits of an anchor's steps.
PLANES = 8
LONG = (1 << 63) - 1
#: Rounding of the bounds, as a share of the lengths multiplied.
SLACK = 1e-9


@dataclass
class Coder:
    """Centres and the rotation of vectors of one length."""

    centres: np.ndarray
    rotation: np.ndarray

    @staticmethod
    def fit(sample: np.ndarray, cells: int) -> "Coder":
        """Centres by a few rounds of k-means from spread-out rows; the same for the same sample."""
        dims = sample.shape[1]
        rotation, _ = np.linalg.qr(np.random.default_rng(dims).normal(size=(dims, dims)))
        centres = sample[np.unique(np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(int))]
        for _ in range(8):
            near = nearest(sample, centres)
            centres = np.array([sample[near == c].mean(0) if (near == c).any() else centres[c] for c in range(len(centres))])
        return Coder(centres, rotation)

    def codes(self, x: np.ndarray, cell: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sign bits (64 to a word), lengths, alignments, and products of centre and difference."""
        gap = x.astype(np.float64) - self.centres[cell]
        turned = gap @ self.rotation
        length = np.sqrt((turned * turned).sum(1))
        align = np.abs(turned).sum(1) / np.sqrt(x.shape[1]) / np.maximum(length, 1e-300)
        return bits(turned > 0), length, np.minimum(align, 1.0), gap @ self.centres[cell]


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    scale = max(1.0, np.abs(x).max(initial=0), np.abs(centres).max(initial=0))  # no overflow
    x, centres = x / scale, centres / scale
    return ((centres * centres).sum(1) - 2 * x @ centres.T).argmin(1)


def bits(signs: np.ndarray) -> np.ndarray:
    words = -(-signs.shape[1] // 64)
    padded = np.zeros((len(signs), words * 64), bool)
    padded[:, :signs.shape[1]] = signs
    return np.packbits(padded, axis=1).view(np.uint64)


def intervals(coder: Coder, cell: int, anchors: np.ndarray, codes) -> tuple[np.ndarray, np.ndarray]:
    """Bounds (anchors by rows) that hold the inner products of anchors with a cell's rows."""
    code, length, align, along = codes
    dims = anchors.shape[1]
    centre = coder.centres[cell]
    gap = (anchors.astype(np.float64) - centre) @ coder.rotation
    low, high = gap.min(1, keepdims=True), gap.max(1, keepdims=True)
    step = np.maximum((high - low) / ((1 << PLANES) - 1), 1e-300)
    steps = np.rint((gap - low) / step).astype(np.int64)
    lost = np.abs(gap - (low + step * steps)).sum(1) / np.sqrt(dims)
    ones = np.bitwise_count(code).sum(1).astype(np.int64)
    # sum of steps under a row's set bits: popcounts of its code with the anchor's bit planes
    under = np.zeros((len(anchors), len(code)), np.int64)
    for p in range(PLANES):
        plane = bits(steps >> p & 1 == 1)
        for w in range(code.shape[1]):
            under += np.bitwise_count(plane[:, w, None] & code[None, :, w]).astype(np.int64) << p
    # product of the anchor's difference with the row's sign vector of length 1
    t = (low * (2 * ones - dims) + step * (2 * under - steps.sum(1, keepdims=True))) / np.sqrt(dims)
    size = np.sqrt((gap * gap).sum(1))[:, None]
    lost = lost[:, None] + SLACK * size
    beside = np.sqrt(np.maximum(0, size ** 2 - np.maximum(0, np.abs(t) - lost) ** 2))
    width = length * (align * lost + np.sqrt(np.maximum(0, 1 - align ** 2) + SLACK) * beside)
    # <q, x> = <q, c> + <c, x - c> + <q - c, x - c>
    middle = (anchors.astype(np.float64) @ centre)[:, None] + along + length * align * t
    width += SLACK * ((np.linalg.norm(anchors.astype(np.float64), axis=1)[:, None] + np.linalg.norm(centre)) * (length + np.linalg.norm(centre))) + 1e-6
    return middle - width, middle + width


def scores(anchors: np.ndarray, rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whole-number products of pairs (i, j); beyond 64 bits they stop at its ends."""
    out = np.zeros(len(i), np.int64)
    most = float(np.abs(anchors.astype(np.float64)).max(initial=0)) * float(np.abs(rows.astype(np.float64)).max(initial=0))
    whole = most * anchors.shape[1] < 2.0 ** 62
    for at in range(0, len(i), 1 << 15):
        s = slice(at, at + (1 << 15))
        if whole:
            out[s] = np.einsum("nd,nd->n", anchors[i[s]], rows[j[s]])
        else:
            wide = (anchors[i[s]].astype(object) * rows[j[s]].astype(object)).sum(1)
            out[s] = [min(max(int(v), -LONG - 1), LONG) for v in wide]
    return out


def kth(values: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """The k-th greatest allowed value of each row; minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(np.where(allowed, values, -np.inf), values.shape[1] - k, 1)[:, values.shape[1] - k]


def first_of(anchor: np.ndarray, score: np.ndarray, vec: np.ndarray, k: int) -> np.ndarray:
    """Places of each anchor's first k by falling score, then vec_id."""
    order = np.lexsort((vec, -score.astype(np.float64), anchor)) if not len(score) or np.abs(score.astype(np.float64)).max() < 2 ** 53 \
        else np.array(sorted(range(len(score)), key=lambda n: (anchor[n], -int(score[n]), vec[n])), int)
    a = anchor[order]
    start = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, int)
    place = np.arange(len(a)) - np.repeat(start, np.diff(np.append(start, len(a))))
    return order[place < k]


TILE = 64


def positives_in(coders, k: int):
    """Of a block, each anchor's first k rows of its label: anchor, vec_id, score."""
    def run(key, anchors, rows):
        dims, cell = key[0].as_py(), key[1].as_py()
        q, x = (matrix_of(t.column("x").combine_chunks(), dims, np.int64) for t in (anchors, rows))
        own, ids, label = (anchors.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "anchor_id", "label"))
        vec, kind = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
        bound = anchors.column("bound").to_numpy()
        codes, out = coders[dims].codes(x, cell), []
        for at in range(0, len(q), TILE):
            s = slice(at, at + TILE)
            allowed = (label[s, None] == kind[None, :]) & (ids[s, None] != vec[None, :])
            low, high = intervals(coders[dims], cell, q[s], codes)
            needed = np.maximum(kth(low, allowed, k), bound[s])
            i, j = np.nonzero(allowed & (high >= needed[:, None]))
            score = scores(q[s], x, i, j)
            best = first_of(i, score, vec[j], k)
            out.append((own[s][i[best]], vec[j[best]], score[best], np.full(len(best), at)))
        cols = [np.concatenate([o[c] for o in out]) for c in range(3)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table({"anchor": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.int64())})

    return run


def negatives_in(coders, k: int, least: int, most: int):
    """Of a block, each anchor's and positive's first k rows of other labels within the window."""
    def run(key, anchors, rows):
        dims, cell = key[0].as_py(), key[1].as_py()
        q, x = (matrix_of(t.column("x").combine_chunks(), dims, np.int64) for t in (anchors, rows))
        own, label = (anchors.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "label"))
        goals = anchors.column("goals").to_pylist()  # positive scores, different ones
        vec, kind = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
        codes, out = coders[dims].codes(x, cell), []
        for at in range(0, len(q), TILE):
            s = slice(at, min(at + TILE, len(q)))
            other = label[s, None] != kind[None, :]
            low, high = intervals(coders[dims], cell, q[s], codes)
            wanted = np.zeros_like(other)
            some = goals[s]
            for g in range(max(map(len, some), default=0)):
                goal = np.array([float(v[g]) if g < len(v) else np.nan for v in some])[:, None]
                floor, roof = np.ceil(least * goal / 100 - 1e-6 - SLACK * np.abs(goal)), np.floor(most * goal / 100 + 1e-6 + SLACK * np.abs(goal))
                sure = other & (low >= floor + 1) & (high <= roof - 1)
                needed = np.maximum(kth(low, sure, k)[:, None], floor)
                wanted |= other & (high >= needed) & (low <= roof)
            i, j = np.nonzero(wanted)
            score = scores(q[s], x, i, j)
            for g in range(max(map(len, some), default=0)):
                goal = np.array([v[g] if g < len(v) else 0 for v in some], object)
                floor = np.array([-((-least * int(v)) // 100) for v in goal], object)
                roof = np.array([most * int(v) // 100 for v in goal], object)
                # beyond 64 bits nothing lies
                lo, hi = (np.array([min(max(int(v), -LONG), LONG) for v in b], np.int64) for b in (floor, roof))
                has = np.array([g < len(v) for v in some], bool)
                n = np.flatnonzero(has[i] & (score >= lo[i]) & (score <= hi[i]))
                best = n[first_of(i[n], score[n], vec[j[n]], k)]
                out.append((own[s][i[best]], goal[i[best]].astype(np.int64), vec[j[best]], score[best]))
        cols = [np.concatenate([o[c] for o in out]) for c in range(4)] if out else [np.zeros(0, np.int64)] * 4
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("anchor", "positive_score", "vec_id", "score"), cols)})

    return run


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
                   cells: int = CELLS, part: int = PART, chunk: int = CHUNK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, embedding, label; other columns are ignored.  Rows with a null vec_id or
    label, a null or empty vector, or null or non-finite components take no part.  Anchors are rows
    whose vec_id ``every`` divides.  Only vectors of one length meet.  Rows with an anchor's vec_id
    are the anchor itself, never its positive.  Repeated rows count each, as candidates and as
    anchors.  Empty table, or no anchors: empty result.  A label is compared as it is."""
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("v")).filter(sound("v"))
    rows = rows.select("vec_id", "label", F.size("v").alias("dims"), F.transform("v", lambda c: F.floor(c * 256)).alias("x"))
    # numbered where it is written: a repeated task writes the table anew as a whole
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "neg-rows")
    coders = {}
    for dims in [r["dims"] for r in rows.select("dims").distinct().collect()]:
        # rows alike are one, so that a vector that very many rows hold is one in the sample
        some = sampled(rows.filter(F.col("dims") == dims).select("x").distinct(), SAMPLE, "x").toArrow()
        x = np.array(some.column("x").to_pylist(), np.float64).reshape(-1, dims)
        if len(x):
            coders[dims] = Coder.fit(x[np.lexsort(x.T)], cells)
        else:
            coders[dims] = Coder(np.zeros((1, dims)), np.eye(dims))

    def place(batches):
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            cell, radius = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                v = matrix_of(batch.column("x").take(pa.array(at)), d, np.float64)
                cell[at] = nearest(v, coders[d].centres)
                radius[at] = np.linalg.norm(v - coders[d].centres[cell[at]], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(radius)], [*names, "cell", "radius"])

    names = ["row", "vec_id", "label", "dims", "x"]
    kinds = "row long, vec_id long, label long, dims int, x array<long>"
    placed = written(rows.select(*names).mapInArrow(place, kinds + ", cell int, radius double"), "neg-placed")
    # (length, cell): at most ``cells`` of each length
    sizes = {(r["dims"], r["cell"]): (-(-r["n"] // max(1, part * WIDE // max(WIDE, r["dims"]))), r["radius"]) for r in placed.groupBy("dims", "cell").agg(
        F.count("*").alias("n"), F.max("radius").alias("radius")).collect()}
    many = F.create_map(*[F.lit(v) for (d, c), (n, _) in sorted(sizes.items()) for v in (f"{d}/{c}", n)]) if sizes else None
    if many is None:
        return vectors.sparkSession.createDataFrame([], RESULT)
    parts = F.element_at(many, F.concat_ws("/", "dims", "cell"))
    in_blocks = placed.withColumn("part", F.pmod(F.xxhash64("row"), parts).cast("int"))
    anchors = in_blocks.filter(F.col("vec_id") % every == 0).withColumnRenamed("row", "anchor").withColumnRenamed("vec_id", "anchor_id")
    chunks = max(1, -(-anchors.count() // chunk))
    anchors = written(anchors.withColumn("chunk", F.pmod(F.xxhash64("anchor"), F.lit(chunks)).cast("int")), "neg-anchors")
    block = ["dims", "cell", "part", "chunk"]

    def meet(asked: DataFrame, run, kind: str) -> DataFrame:
        """Anchors with the blocks they are sent to, and the rows of those blocks, a task a block and
        chunk; rows go to the chunks that ask for them."""
        there = asked.select(*block).distinct().toDF(*block)  # columns of its own: both sides come from the same rows
        given = in_blocks.select("dims", "cell", "part", "vec_id", "label", "x").toDF("dims", "cell", "part", "vec_id", "label", "x")
        given = given.join(there, ["dims", "cell", "part"])
        return asked.groupBy(*block).cogroup(given.groupBy(*block)).applyInArrow(run, kind)

    def best(found: DataFrame, by: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    def sent(batches):
        """Each anchor with all blocks whose best possible score reaches its bound."""
        for batch in batches:
            dims, bound = batch.column("dims").to_numpy(), batch.column("bound").to_numpy()
            take, cell, parts = [], [], []
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                v = matrix_of(batch.column("x").take(pa.array(at)), d, np.float64)
                size = np.linalg.norm(v, axis=1)
                for c, centre in enumerate(coders[d].centres):
                    n, radius = sizes.get((d, c), (0, 0.0))
                    reach = v @ centre + size * radius
                    go = at[reach + SLACK * size * (np.linalg.norm(centre) + radius) + 1e-6 >= bound[at]]
                    take.append(np.repeat(go, n))
                    cell.append(np.full(n * len(go), c))
                    parts.append(np.tile(np.arange(n), len(go)))
            take, cell, parts = (np.concatenate([*v, np.zeros(0, np.int64)]).astype(np.int64) for v in (take, cell, parts))
            one = batch.take(pa.array(take))
            yield pa.RecordBatch.from_arrays(
                [one.column(c) for c in one.schema.names if c not in ("cell", "part")] + [pa.array(cell, pa.int32()), pa.array(parts, pa.int32())],
                [c for c in one.schema.names if c not in ("cell", "part")] + ["cell", "part"])

    base = "anchor long, anchor_id long, label long, dims int, x array<long>, chunk int, bound double"
    asked = ["anchor", "anchor_id", "label", "dims", "x", "chunk", "bound"]
    scored = "anchor long, vec_id long, score long"
    nothing = F.lit(float("-inf"))
    # its own block gives an anchor a lower bound of its last positive
    home = meet(anchors.withColumn("bound", nothing).select(*asked, "cell", "part"), positives_in(coders, positives), scored)
    home = home.groupBy("anchor").agg(F.min("score").alias("worst"), F.count("*").alias("n"))
    seeds = anchors.select(*[c for c in asked if c != "bound"]).join(home, "anchor", "left").withColumn(
        "bound", F.when(F.col("n") >= positives, F.col("worst").cast("double")).otherwise(nothing))
    seeds = written(seeds.select(*asked), "neg-seeds")
    found = meet(seeds.mapInArrow(sent, base + ", cell int, part int"), positives_in(coders, positives), scored)
    found = written(best(found, ["anchor"], positives).select(
        "anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "neg-positives")
    # an anchor asks once for each different score of its positives
    goals = found.groupBy("anchor").agg(F.array_sort(F.collect_set("positive_score")).alias("goals"))
    windows = anchors.select(*[c for c in asked if c != "bound"]).join(goals, "anchor").withColumn(
        "bound", F.array_min("goals").cast("double") * least / 100 - 1)
    windows = windows.filter(F.array_max("goals") >= 0).select(*asked, "goals")  # of a negative score the window is empty
    near = meet(windows.mapInArrow(sent, base + ", goals array<long>, cell int, part int"),
                negatives_in(coders, negatives, least, most), "anchor long, positive_score long, vec_id long, score long")
    near = best(near, ["anchor", "positive_score"], negatives)
    out = found.join(near, ["anchor", "positive_score"]).join(anchors.select("anchor", "anchor_id"), "anchor")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                      "positive_score", F.col("score").alias("negative_score"))


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
