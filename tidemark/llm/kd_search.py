"""Exact top-k search by inner product with a k-d tree per shard.

Vectors are dealt into shards; a shard becomes one row, its vectors in the order of a k-d tree
(median splits on the widest side) with a tight box for every node.  No vector in a box scores
above sum_i max(q_i * low_i, q_i * high_i), so a query takes the boxes best first and stops
where the bound falls below the kth score it has.  Shards are dealt into groups, and a block of
queries goes to a group once, whatever shards are in it: a task holds the trees of its group while
the blocks stream by.  Every block meets one group first; the kth scores found there go along to
all other groups, and with them boxes need not be opened.  Queries of a block that open the same
box are multiplied with it at once.  All scores are integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import by_value, released, written
from tidemark.llm.subspace_join import sound

by_value(__name__)

#: Vectors in a shard, queries in a block, vectors in a leaf, about.
SHARD, QUERIES, LEAF = 8192, 512, 128
#: Vectors in a group of shards and components of all its vectors, at most, about.
MEMBERS, GROUP = 1 << 18, 1 << 24
#: Groups that a table has at least, where it has as many shards: they are the tasks of a search.
TASKS = 16
#: A query without a kth score has these for it and for the id that goes with it.
NONE, LAST = -(1 << 62), (1 << 63) - 1
#: Leaves that a query opens at most before it opens all that are left; candidates kept before they are cut to k.
WIDEST, KEPT = 64, 1 << 16


def kd_tree(v: np.ndarray, leaf: int = LEAF):
    """Order of the rows; nodes (first row, end, left child or -1); lows and highs of their boxes.
    The right child stands after the left."""
    order = np.arange(len(v))
    nodes, queue = [[0, len(v), -1]], [0]
    for n in queue:
        a, b, _ = nodes[n]
        if b - a <= leaf:
            continue
        rows = v[order[a:b]]
        width = rows.max(0) - rows.min(0)
        if not width.any():
            continue
        axis, mid = int(width.argmax()), (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(rows[:, axis], mid)]
        nodes[n][2] = len(nodes)
        queue += [len(nodes), len(nodes) + 1]
        nodes += [[a, a + mid, -1], [a + mid, b, -1]]
    v = v[order]
    low = np.array([v[a:b].min(0) for a, b, _ in nodes])
    high = np.array([v[a:b].max(0) for a, b, _ in nodes])
    return order, np.array(nodes, np.int64), low, high


def packed(*arrays: np.ndarray) -> list[bytes]:
    """Each as the shortest integers that hold it."""
    out = []
    for a in arrays:
        least, most = (int(a.min()), int(a.max())) if a.size else (0, 0)
        kind = next(t for t in "bhiq" if np.iinfo(t).min <= least and most <= np.iinfo(t).max)
        out.append(np.ascontiguousarray(a, kind).tobytes())
    return out


def unpacked(data, *shape: int) -> np.ndarray:
    """What ``packed`` made of an array of this shape."""
    return np.frombuffer(data, f"i{len(data) // max(1, int(np.prod(shape)))}").reshape(shape)


def vectors_of(table: pa.Table, dims: int) -> np.ndarray:
    parts = [c.flatten().to_numpy(zero_copy_only=False) for c in table.column("v").chunks]
    return np.concatenate(parts).astype(np.int64, copy=False).reshape(-1, dims)


def shards(vectors: DataFrame, count: int) -> DataFrame:
    """One row per (shard, dims): ids, vectors in tree order, nodes and boxes."""
    def run(key, table):
        shard, dims = (x.as_py() for x in key)
        v = vectors_of(table, dims)
        ids = table.column("vec_id").to_numpy()
        first = np.argsort(ids, kind="stable")
        order, nodes, low, high = kd_tree(v[first])
        order = first[order]
        cols = [ids[order].tobytes(), *packed(v[order]), nodes.tobytes(), *packed(low, high)]
        return pa.table([pa.array([shard], pa.int32()), pa.array([dims], pa.int32()),
                         *(pa.array([c], pa.binary()) for c in cols)],
                        ["shard", "dims", "ids", "v", "nodes", "low", "high"])

    return (vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(count)).cast("int"))
            .groupBy("shard", "dims").applyInArrow(
                run, "shard int, dims int, ids binary, v binary, nodes binary, low binary, high binary"))


def query_blocks(vectors: DataFrame, every: int, count: int) -> DataFrame:
    """One row per (block, dims) of the query rows: ids, vectors, kth scores and their ids (none yet)."""
    def run(key, table):
        block, dims = (x.as_py() for x in key)
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        cols = [ids[order].tobytes(), *packed(vectors_of(table, dims)[order]),
                np.full(len(ids), NONE).tobytes(), np.full(len(ids), LAST).tobytes()]
        return pa.table([pa.array([block], pa.int32()), pa.array([dims], pa.int32()),
                         *(pa.array([c], pa.binary()) for c in cols)], ["block", "dims", "ids", "v", "kth", "kth_id"])

    return (vectors.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"])
            .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int"))
            .groupBy("block", "dims").applyInArrow(
                run, "block int, dims int, ids binary, v binary, kth binary, kth_id binary"))


def best(k: int, rows: np.ndarray, ids: np.ndarray, score: np.ndarray):
    """The k best candidates of each row, ties to the smaller id, by row and rank; the ranks."""
    order = np.lexsort((ids, -score, rows))
    rows, ids, score = rows[order], ids[order], score[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
    some = rank < k
    return rows[some], ids[some], score[some], rank[some]


class Forest:
    """The trees of the shards of a group, of vectors of one length, to be searched together."""

    def __init__(self, trees: list[dict], dims: int):
        ids, v, leaves, low, high, top, n = [], [], [], [], [], [], 0
        for t in trees:
            ids.append(np.frombuffer(t["ids"], np.int64))
            nodes = np.frombuffer(t["nodes"], np.int64).reshape(-1, 3)
            v.append(unpacked(t["v"], len(ids[-1]), dims))
            leaf = nodes[:, 2] < 0
            leaves.append(nodes[leaf, :2] + n)
            for boxes, name in ((low, "low"), (high, "high")):
                box = unpacked(t[name], len(nodes), dims)
                boxes.append(box[leaf])
                top.append(box[0])
            n += len(ids[-1])
        self.n, self.opened = n, 0
        if not n:
            return
        self.ids, self.leaves = np.concatenate(ids), np.concatenate(leaves)
        self.first = np.cumsum([0, *map(len, leaves)])
        self.whole = [np.concatenate(v), np.concatenate(low), np.concatenate(high), np.stack(top[::2]), np.stack(top[1::2])]
        self.most = max(-float(self.whole[3].min()), float(self.whole[4].max()))
        self.kind = None

    def arrays(self, q: np.ndarray):
        """Vectors and boxes as numbers in which every product with q, and each sum on the way to it, is exact."""
        size = np.abs(q.astype(np.float64)).sum(1).max() * self.most
        kind = np.float32 if size < 1 << 24 else np.float64 if size < 1 << 53 else np.int64
        if kind is not self.kind:
            self.kind, self.numbers = kind, [a.astype(kind) for a in self.whole]
        return kind, self.numbers

    def search(self, k: int, q_ids: np.ndarray, q: np.ndarray, kth: np.ndarray, kth_id: np.ndarray):
        """Rows of q, vec_ids and scores of the up to k best candidates of each query that come before its
        kth, as (score, id); kth and kth_id are moved on where k candidates have been found here."""
        found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not self.n or not len(q):
            return found
        kind, (v, low, high, top_low, top_high) = self.arrays(q)
        x, least = q.astype(kind), kth.astype(kind)
        up, down = np.maximum(x, 0), np.minimum(x, 0)
        # shards that some query may need; as good as the kth still counts: the id may be smaller
        some = (up @ top_high.T + down @ top_low.T >= least[:, None]).any(0)
        boxes = np.flatnonzero(np.repeat(some, np.diff(self.first)))
        if len(boxes) < len(low):
            low, high = low[boxes], high[boxes]
        bound = up @ high.T + down @ low.T
        shut = np.iinfo(kind).min if kind is np.int64 else -np.inf
        more, waiting, width = [], 0, 1
        while True:
            take = bound >= least[:, None]
            rest = width > WIDEST or np.count_nonzero(take) <= 4 * width * len(q)
            if not rest:
                near = np.zeros_like(take)
                np.put_along_axis(near, np.argpartition(bound, -width, 1)[:, -width:], True, 1)
                take &= near
                bound[take] = shut
            wanted = np.ascontiguousarray(take.T)
            for n in np.flatnonzero(wanted.any(1)):
                who = np.flatnonzero(wanted[n])
                self.opened += len(who)
                asked = x if len(who) == len(x) else x[who]
                first, end = self.leaves[boxes[n]]
                for a in range(first, end, SHARD):  # equal vectors are one leaf, however many
                    b = min(end, a + SHARD)
                    hit = np.flatnonzero((s := asked @ v[a:b].T) >= least[who, None])
                    if not len(hit):
                        continue
                    rows, ids, score = who[hit // (b - a)], self.ids[a + hit % (b - a)], s.ravel()[hit].astype(np.int64)
                    good = (ids != q_ids[rows]) & ((score > kth[rows]) | (ids < kth_id[rows]))
                    more.append((rows[good], ids[good], score[good]))
                    waiting += len(more[-1][0])
                    if waiting >= KEPT:
                        found, more, waiting = self.cut(k, found, more, kth, kth_id), [], 0
                        least = kth.astype(kind)
            found, more, waiting = self.cut(k, found, more, kth, kth_id), [], 0
            least = kth.astype(kind)
            if rest:
                return found
            width *= 8

    @staticmethod
    def cut(k: int, found: tuple, more: list[tuple], kth: np.ndarray, kth_id: np.ndarray):
        *found, rank = best(k, *(np.concatenate(c) for c in zip(found, *more)))
        full = rank == k - 1
        kth[found[0][full]], kth_id[found[0][full]] = found[2][full], found[1][full]
        return tuple(found)


ROW = "dims int, ids binary, v binary, nodes binary, low binary, high binary, kth binary, kth_id binary"
MET = "block int, dims int, ids binary, v binary, kth binary, kth_id binary, query_id binary, vec_id binary, score binary"
FOUND = "query_id long, vec_id long, score long"


def meet(k: int, size: int, first: bool):
    """For each group its trees, then the blocks, ``size`` queries at a time.  Gives each block with
    its kth scores and what it found, as MET, for a first group, else only what it found, as FOUND."""
    names = [c.split()[0] for c in ROW.split(", ")]

    def run(batches):
        at, trees, forest = None, [], None
        for batch in batches:
            for r in range(batch.num_rows):
                here = batch.column("home")[r].as_py(), batch.column("dims")[r].as_py()
                if here != at:
                    at, trees, forest = here, [], None
                data = {c: cell.as_buffer() for c in names[1:] if (cell := batch.column(c)[r]).is_valid}
                if "nodes" in data:
                    trees.append(data)
                    continue
                if forest is None:
                    forest, trees = Forest(trees, here[1]), []
                ids, kth, kth_id = (np.frombuffer(data[c], np.int64).copy() for c in ("ids", "kth", "kth_id"))
                q, found = unpacked(data["v"], len(ids), here[1]), []
                for n in range(0, len(ids), size):
                    part = slice(n, n + size)
                    rows, *some = forest.search(k, ids[part], q[part], kth[part], kth_id[part])
                    found.append((ids[part][rows], *some))
                found = [np.concatenate(c) for c in zip(*found)]
                if first:
                    cols = [data["ids"].to_pybytes(), data["v"].to_pybytes(), *(c.tobytes() for c in (kth, kth_id, *found))]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(c).slice(r, 1) for c in ("part", "dims")] + [pa.array([c], pa.binary()) for c in cols],
                        [c.split()[0] for c in MET.split(", ")])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], [c.split()[0] for c in FOUND.split(", ")])

    return released(run)


def found_rows(batches):
    """What blocks found (MET) as rows."""
    names = [c.split()[0] for c in FOUND.split(", ")]
    for batch in batches:
        for r in range(batch.num_rows):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(batch.column(c)[r].as_buffer(), np.int64)) for c in names], names)


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, shard: int = SHARD,
          queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: for every row whose vec_id is divisible by ``every`` the k
    greatest integer inner products with any row of another vec_id, ties to the smaller vec_id.

    Vectors that are null, empty or hold null or non-finite components, and rows without vec_id,
    take no part; zero vectors do.  Only vectors of one length meet.  Repeated rows are candidates
    each; a query repeated with one vector is asked once.  Fewer than k candidates: all of them.
    Empty table: empty result.  Other columns are ignored."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("x")).filter(
        F.col("vec_id").isNotNull() & sound("x"))
    rows = written(rows.select("vec_id", F.size("x").alias("dims"),
                               F.transform("x", lambda c: F.floor(c * scale).cast("bigint")).alias("v")), "kd-rows")
    total, asking, components = rows.agg(
        F.count("*"), F.count_if(F.col("vec_id") % every == 0), F.coalesce(F.sum("dims"), F.lit(0))).first()
    count, blocks = -(-total // shard) or 1, -(-asking // queries) or 1
    # as many groups as queries are rarer than vectors: their copies are no more than the vectors
    groups = max(min(count, max(TASKS, total // max(1, asking))), -(-total // MEMBERS), -(-components // GROUP))
    tree = written(shards(rows, count), "kd-shards").withColumns(
        {"home": F.pmod("shard", F.lit(groups)), "kind": F.lit(0), "part": F.col("shard")})
    home = F.pmod("block", F.lit(groups))

    def met(asked: DataFrame, first: bool) -> DataFrame:
        both = tree.unionByName(asked.withColumns({"kind": F.lit(1), "part": F.col("block")}), allowMissingColumns=True)
        return (both.select("home", "kind", "part", *[c.split()[0] for c in ROW.split(", ")])
                .repartitionById(groups, F.col("home")).sortWithinPartitions("home", "dims", "kind", "part")
                .mapInArrow(meet(k, queries, first), MET if first else FOUND))

    # a block's first group; a group without vectors of these dims adds nothing
    start = written(met(query_blocks(rows, every, blocks).withColumn("home", home), True), "kd-first")
    others = start.drop("query_id", "vec_id", "score").withColumn(
        "home", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).filter(F.col("home") != home)
    found = start.select("query_id", "vec_id", "score").mapInArrow(found_rows, FOUND).unionByName(met(others, False))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
