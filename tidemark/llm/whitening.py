"""Whitening of embeddings by QDWH spectral divide and conquer.

Vectors become integers; the fit list is each distinct one once.  Its sums and its covariance
(centred before multiplying) are added up in tasks.  What comes to the driver is one matrix of
dimensions by dimensions, whatever the number of rows.  There the polar factor of the shifted
covariance, found by dynamically weighted Halley steps (QDWH), gives the projector on the
eigenvectors above the shift; it splits the space in two invariant subspaces, and each half is
split again until single components are left.  Only the subspaces that hold wanted components are
split.  Mean, axes and scales are then broadcast, and every row is whitened in one pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_value, written
from tidemark.llm.subspace_join import sound

by_value(__name__)

COMPONENTS = 4
#: Directions whose share of the trace is below this hold no spread; they are no components.
NOTHING = 1e-13
LONG = (1 << 63) - 1


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH: cubic, weights from a lower bound
    of the least singular value, each step by a QR factorization.  At most about six steps."""
    n = len(a)
    x = a / max(np.linalg.norm(a), 1e-300)
    # least singular value >= 1 / norm of the inverse of the triangular factor
    r = np.linalg.qr(x, "r")
    tiny = np.abs(np.diag(r)).min() < 1e-16
    low = 1e-16 if tiny else min(1.0, max(1e-16, 1 / np.linalg.norm(np.linalg.solve(r, np.eye(n)))))
    for _ in range(30):
        d = (4 * (1 - low * low) / low ** 4) ** (1 / 3)
        s = np.sqrt(1 + d)
        wa = s + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low * low) / (low * low * s)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.concatenate([np.sqrt(wc) * x, np.eye(n)]))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:n] @ q[n:].T
        new = (new + new.T) / 2
        step = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (wa + wb * low * low) / (1 + wc * low * low))
        if step < 1e-15 * n + 1e-14 and 1 - low < 1e-14:
            break
    return x


def halves(a: np.ndarray, shift: float, scale: float):
    """Bases of the invariant subspaces of ``a`` above and below ``shift``; None where an
    eigenvalue is too near the shift to tell, or all lie on one side."""
    n = len(a)
    projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    k = int(round(np.trace(projector)))
    if not 0 < k < n or np.abs(projector @ projector - projector).max() > 1e-10:
        return None
    turn = np.random.default_rng(n).normal(size=(n, n))
    for _ in range(3):  # subspace iteration; the projector makes the first one nearly exact
        turn, _ = np.linalg.qr(np.concatenate([projector @ turn[:, :k], turn[:, k:] - projector @ turn[:, k:]], 1))
        if np.abs(turn[:, :k].T @ a @ turn[:, k:]).max() <= 8 * n * np.finfo(float).eps * scale:
            return turn[:, :k], turn[:, k:]
    return None


def eigen(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues of a symmetric matrix, falling, and their unit vectors
    as columns, by spectral divide and conquer; each vector's greatest entry is positive."""
    scale = max(np.linalg.norm(a), 1e-300)
    values, vectors = [], []

    def split(part: np.ndarray, basis: np.ndarray) -> None:
        n = len(part)
        level = np.trace(part) / n
        rest = part - level * np.eye(n)
        if n == 1 or np.linalg.norm(rest) <= 4 * n * np.finfo(float).eps * scale:
            # one component, or a space in which all directions are alike
            values.extend([part[i, i] for i in range(n)])
            vectors.extend(basis.T)
            return
        spread = np.linalg.norm(rest) / np.sqrt(n)
        # some eigenvalues lie on either side of the mean; other shifts where one is too near it
        shifts = [level] + [level + k * spread * sign for k in (.05, .2, .45, .8, 1.3, .01, 2, 3.1) for sign in (1, -1)]
        for shift in shifts:
            found = halves(part, shift, scale)
            if found is not None:
                break
        else:
            # no shift parts it: its eigenvalues differ by rounding alone, and any axes do
            values.extend(np.diag(part))
            vectors.extend(basis.T)
            return
        for half in found:  # the upper half first
            if len(values) < wanted:
                one = half.T @ part @ half
                split((one + one.T) / 2, basis @ half)

    split((a + a.T) / 2, np.eye(len(a)))
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    axes = np.array(vectors)[order].T
    axes = axes / np.linalg.norm(axes, axis=0)
    axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])] < 0, -1, 1)
    return np.array(values)[order], axes


def matrix_of(column: pa.Array, dims: int, kind) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dims).astype(kind, copy=False)


def added(table: DataFrame, of, width: int) -> list[float]:
    """The sums of ``of(rows)`` (``width`` numbers) over all rows of ``table`` (column x): added up
    within each task, then by place over tasks."""
    def run(batches):
        total = None
        for batch in batches:
            one = of(batch.column("x"))
            total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array([str(int(t)) if total.dtype == object else None for t in total], pa.string()),
                                              pa.array([0.0 if total.dtype == object else float(t) for t in total])], ["at", "whole", "real"])

    parts = table.select("x").mapInArrow(run, "at long, whole string, real double")
    sums = parts.groupBy("at").agg(F.sum(F.col("whole").cast("decimal(38,0)")).alias("whole"), F.sum("real").alias("real"))
    out: list = [0] * width
    for r in sums.collect():  # ``width`` rows
        out[r["at"]] = int(r["whole"]) if r["whole"] is not None else r["real"]
    return out


def exact_sums(x: np.ndarray) -> np.ndarray:
    """Column sums as whole numbers of any size, and the number of rows in front."""
    if not len(x):
        return np.zeros(x.shape[1] + 1, object)
    small = max(abs(int(x.min())), abs(int(x.max()))) < (1 << 62) // len(x)
    total = x.sum(0).astype(object) if small else x.astype(object).sum(0)
    return np.concatenate([np.array([len(x)], object), total])


class Centred:
    """Rows less the mean S / n.  n * x - S is a whole number: exact."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.base = np.array([min(max(s // n, -LONG), LONG) for s in sums], np.int64)
        self.left = np.array([(s - int(b) * n) / n for s, b in zip(sums, self.base)])

    def rows(self, x: np.ndarray) -> np.ndarray:
        if len(x) and np.abs(x.astype(np.float64)).max() < 2 ** 61 and np.abs(self.base.astype(np.float64)).max() < 2 ** 61:
            return (x - self.base).astype(np.float64) - self.left
        return x.astype(np.float64) - self.base.astype(np.float64) - self.left

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S)^2 of each row; None beyond 64 bits."""
        if not len(x):
            return []
        most = self.n * float(np.abs(x.astype(np.float64)).max()) + max((abs(s) for s in self.sums), default=0)
        if most * most * x.shape[1] < 2.0 ** 62:
            gap = self.n * x - np.array(self.sums, np.int64)
            return (gap * gap).sum(1).tolist()
        gap = self.n * x.astype(object) - np.array(self.sums, object)
        return [int(d) if d <= LONG else None for d in (gap * gap).sum(1)]


def fit(distinct: DataFrame, dims: int, components: int):
    """The model of the distinct rows (column x, ``dims`` long)."""
    n, *sums = (int(v) for v in added(distinct, lambda c: exact_sums(matrix_of(c, dims, np.int64)), dims + 1))
    centred = Centred(n, sums)

    def products(column):
        c = centred.rows(matrix_of(column, dims, np.int64))
        return (c.T @ c).ravel()

    covariance = np.array(added(distinct, products, dims * dims), float).reshape(dims, dims) / n
    values, axes = eigen(covariance, min(components, dims))
    trace = float(np.trace(covariance))
    some = values > NOTHING * trace
    values, axes = values[some], axes[:, some]
    scaled = axes / np.sqrt(values)
    k = len(values)
    error = 0.0
    if k:
        def moments(column):
            z = centred.rows(matrix_of(column, dims, np.int64)) @ scaled
            return np.concatenate([z.sum(0), (z.T @ z).ravel()])

        total = np.array(added(distinct, moments, k + k * k), float) / n
        error = float(np.abs(total[k:].reshape(k, k) - np.outer(total[:k], total[:k]) - np.eye(k)).max())
    return centred, scaled, values / trace if k else values, error


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each sound row of ``vectors`` (vec_id, embedding; other columns are ignored) and
    each of the first ``components`` components: vec_id, component (from 1), n, deviation, whitened,
    explained, identity_error.

    Rows whose vector is null, empty or holds null or non-finite entries are dropped.  Vectors of
    different lengths are fitted apart.  Equal rows are fitted once and all returned; a null
    vec_id is kept.  Directions without spread (all rows alike, fewer rows than dimensions) are no
    components: such rows have fewer or none.  Where eigenvalues tie, any axes of their space may
    come.  A deviation beyond 64 bits is null.  Empty table: empty result."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).filter(sound("v"))
    rows = rows.select("vec_id", F.size("v").alias("dims"), F.transform("v", lambda c: F.floor(c * 256) + F.lit(0).cast("bigint")).alias("x"))
    rows = written(rows, "white-rows")
    # the vector itself is the key: copies fall together in the task that reads them
    distinct = written(rows.select("dims", "x").distinct(), "white-distinct")
    models = {}
    for dims in [r["dims"] for r in distinct.select("dims").distinct().collect()]:
        models[dims] = fit(distinct.filter(F.col("dims") == dims), dims, components)

    def run(batches):
        for batch in batches:
            lengths = batch.column("dims").to_numpy()
            for dims in np.unique(lengths):
                centred, scaled, explained, error = models[dims]
                at = pa.array(np.flatnonzero(lengths == dims))
                x = matrix_of(batch.column("x").take(at), dims, np.int64)
                k = scaled.shape[1]
                if not k:
                    continue
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(at).take(pa.array(np.repeat(np.arange(len(x)), k))),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, centred.n)),
                     pa.array([d for d in centred.deviation(x) for _ in range(k)], pa.int64()),
                     pa.array((centred.rows(x) @ scaled).ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
