"""Near copies among vectors by a subspace pigeonhole join.

Unit vectors link when their squared distance is at most D = 2 - 2 * cosine.  They are rotated
(principal axes of a bounded sample, dealt over the blocks so that each has a strong axis) and
split into low-dimensional blocks.  Block b gets the part of D that its share of the spread makes:
the parts sum to D, so a pair within D is within its budget in some block.  Each block is a range
join: cells of a grid on its two strongest axes, cells no narrower than twice the block's range,
so that a vector visits few cells beside its own.  Pairs that meet are verified in double
precision, and counted in the first block whose budget they keep: once.

Equal vectors are one row.  Cells of any size are cut into parts, and a task joins two parts, so
no task holds more than two of them; what a task returns is a row per vector, never per pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_value, sampled, written
from tidemark.llm.components import components

by_value(__name__)

BLOCKS = 8
#: Vectors the axes are fitted on, about.
SAMPLE = 4096
#: Rows in a part of a cell, about.
PART = 2048
SLACK = 1e-7


def sound(v: str = "embedding"):
    """Whether a vector is there, without null or non-finite components."""
    return F.col(v).isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def split_axes(sample: np.ndarray, blocks: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """A rotation, the axes of each block (strongest first), and each block's share of the spread."""
    dims = sample.shape[1]
    spread, axes = np.linalg.eigh(sample.T @ sample / max(1, len(sample)) + 1e-9 * np.eye(dims))
    order = np.argsort(-spread)
    axes, spread = axes[:, order], np.maximum(spread[order], 1e-9)
    parts = [np.arange(b, dims, blocks) for b in range(min(blocks, dims))]
    share = np.array([spread[p].sum() for p in parts])
    return axes, parts, share / share.sum()


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)  # no component is lost to overflow or underflow
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def cells_of(vectors: DataFrame, model) -> DataFrame:
    """A row for the cell a vector lives in and for each it visits: block, cx, cy, home."""
    def run(batches):
        for batch in batches:
            vectors, lengths, out = batch.column("vector").to_pylist(), batch.column("dims").to_numpy(), []
            for dims in np.unique(lengths):
                rows = np.flatnonzero(lengths == dims)
                axes, parts, ranges = model[dims]
                turned = unit(np.array([vectors[r] for r in rows], np.float64)) @ axes
                for b, (part, r) in enumerate(zip(parts, ranges)):
                    wide, first, second = 2 * r, turned[:, part[0]], turned[:, part[min(1, len(part) - 1)]]
                    cx, cy = np.floor(first / wide).astype(np.int64), np.floor(second / wide).astype(np.int64)
                    out.append((rows, b, cx, cy, np.ones(len(rows), bool)))
                    # half of the cells around: of two that see each other, one visits
                    for dx, dy in ((0, 1), (1, -1), (1, 0), (1, 1)):
                        near = (np.abs(first - np.clip(first, (cx + dx) * wide, (cx + dx + 1) * wide)) <= r) & (
                            np.abs(second - np.clip(second, (cy + dy) * wide, (cy + dy + 1) * wide)) <= r)
                        out.append((rows[near], b, cx[near] + dx, cy[near] + dy, np.zeros(int(near.sum()), bool)))
            take = np.concatenate([o[0] for o in out])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(take)) for c in ("id", "label", "dims")]
                + [pa.array(np.concatenate([np.full(len(o[0]), o[1], np.int32) for o in out]))]
                + [pa.array(np.concatenate([o[k] for o in out])) for k in (2, 3, 4)],
                ["id", "label", "dims", "block", "cx", "cy", "home"])

    kind = vectors.schema["label"].dataType.simpleString()
    return vectors.select("id", "label", "dims", "vector").mapInArrow(
        run, f"id binary, label {kind}, dims int, block int, cx long, cy long, home boolean")


def joiner(model, cosine: float):
    """Joins the rows of one task: links of each vector, and a spanning forest of them."""
    def near(x: np.ndarray, y: np.ndarray, turned_x, turned_y, block: int, parts, budgets):
        """Index pairs that link and whose first block within its budget is ``block``."""
        i, j = np.nonzero(x @ y.T >= cosine - SLACK)
        mine = np.ones(len(i), bool)
        exact = np.zeros(len(i))
        for at in range(0, len(i), 1 << 15):
            s = slice(at, at + (1 << 15))
            exact[s] = np.einsum("nd,nd->n", x[i[s]], y[j[s]])
            gap = (turned_x[i[s]] - turned_y[j[s]]) ** 2
            for b in range(block + 1):
                within = gap[:, parts[b]].sum(1) <= budgets[b]
                mine[s] &= within if b == block else ~within
        keep = mine & (exact >= cosine)
        return i[keep], j[keep]

    def run(key, table):
        dims, block = key[1].as_py(), key[2].as_py()
        low, high = key[5].as_py(), key[6].as_py()
        axes, parts, ranges = model[dims]
        budgets = ranges ** 2
        ids = table.column("id").to_pylist()
        home, part = table.column("home").to_numpy(zero_copy_only=False), table.column("part").to_numpy()
        weight = table.column("copies").to_numpy()
        v = unit(np.array(table.column("vector").to_pylist(), np.float64))
        turned = v @ axes
        a_side, b_side = np.flatnonzero(part == low), np.flatnonzero(part == high)
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        tile = 1024
        for p in range(0, len(a_side), tile):
            for q in range(0 if low != high else p, len(b_side), tile):
                x, y = a_side[p:p + tile], b_side[q:q + tile]
                i, j = near(v[x], v[y], turned[x], turned[y], block, parts, budgets)
                i, j = x[i], y[j]
                ok = (home[i] | home[j]) & ((i < j) if low == high and p == q else True)
                i, j = i[ok], j[ok]
                np.add.at(links, i, weight[j])
                np.add.at(links, j, weight[i])
                # a forest of what this tile links, not its pairs
                while len(i):
                    ri, rj = root[i], root[j]
                    new = ri != rj
                    if not new.any():
                        break
                    i, j, ri, rj = i[new], j[new], ri[new], rj[new]
                    np.minimum.at(root, np.maximum(ri, rj), np.minimum(ri, rj))
                    while (root[root] != root).any():
                        root = root[root]
        rows = np.flatnonzero(links)
        return pa.table({"a": pa.array([ids[r] for r in rows], pa.binary()),
                         "b": pa.array([ids[root[r]] for r in rows], pa.binary()), "links": pa.array(links[rows])})

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.98, blocks: int = BLOCKS, part: int = PART,
                 sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label; other columns are ignored):
    vec_id, n_links, component_id, kept.

    Only vectors of one label and one length meet.  Vectors that are null, empty, zero or hold
    null or non-finite components, and those without label, have no link and are their own
    component.  Repeated vectors link with each other.  Rows with one vec_id are rows of their
    own; a null vec_id is never the smallest.  Empty table: empty result."""
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.withColumn("usable", F.col("label").isNotNull() & sound("vector")
                           & F.exists("vector", lambda x: x != 0.0))
    # equal vectors of one label are one row: two 64-bit hashes of the vector, its label and length
    identity = F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(k), "label", "vector")), 16, "0") for k in (1, 2)])
    rows = written(rows.withColumn("id", F.when(F.col("usable"), F.unhex(identity))), "vec-rows")
    own = rows.filter("usable")
    classes = own.groupBy("id").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"),
                                    F.any_value("label").alias("label"), F.any_value("vector").alias("vector"))
    classes = written(classes.withColumn("dims", F.size("vector")), "vec-classes")
    model = {}
    budget = 2 - 2 * cosine + SLACK
    for dims in [r["dims"] for r in classes.select("dims").distinct().collect()]:
        some = sampled(classes.filter(F.col("dims") == dims), sample, "id").select("vector").toArrow()
        x = unit(np.array(some.column("vector").to_pylist(), np.float64).reshape(-1, dims)) if some.num_rows else np.zeros((0, dims))
        axes, parts, share = split_axes(x, blocks)
        model[dims] = axes, parts, np.sqrt(budget * share * (1 + 1e-9)) + 1e-12

    cells = written(cells_of(classes, model), "vec-cells")
    where = ["label", "dims", "block", "cx", "cy"]
    # cells where nothing can meet go; large ones are cut into parts
    full = (cells.groupBy(*where).agg(F.count("*").alias("n"), F.max("home").alias("lived"))
            .filter("n > 1 and lived").select(*where, F.ceil(F.col("n") / part).cast("int").alias("parts")))
    mine = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    dealt = (cells.join(full, where).withColumn("part", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other")))
    joined = (dealt.join(classes.select("id", "vector", "copies"), "id")
              .select(*where, "low", "high", "id", "home", "part", "copies", "vector")
              .groupBy(*where, "low", "high").applyInArrow(joiner(model, cosine), "a binary, b binary, links long"))
    links = written(joined, "vec-links")
    parts = components(links.filter("a != b").select("a", "b"))
    degree = links.groupBy("a").agg(F.sum("links").alias("links"))
    named = (classes.select("id", "copies", "least").join(degree.withColumnRenamed("a", "id"), "id", "left")
             .join(parts.withColumnRenamed("v", "id"), "id", "left").withColumn("root", F.coalesce("root", "id")))
    named = written(named, "vec-named")
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(lowest, "root").select(
        "id", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = rows.select("vec_id", "id").join(named, "id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
