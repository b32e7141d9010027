"""Event-time watermark of a log with several partitions, with an idle rule.

Each partition has its own watermark: the newest event time among its records so far, less the
delay.  The log's watermark is the least of its partitions' and never goes back.  A partition
without a record for ``idle_batches`` arrival batches is idle and doesn't count until it has one
again; otherwise one quiet partition would hold all windows open.  A partition counts from its
first record on.  While all are idle, the watermark stays.

Running maxima are scans of two levels: the maximum of each block, the running maximum over the
blocks before, and the running maximum inside a block.  No task holds a whole partition.  Batches
are whole numbers; batches in which nothing arrived have a row too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.codec import minus_seconds, truncate_ms

#: Offsets of a block of records, and batches of a block of the trace.
BLOCK_OFFSETS, BLOCK_BATCHES = 1 << 16, 1 << 10


def running_max(df: DataFrame, parts: Sequence[str], order: str, size: int, values: dict[str, str]) -> DataFrame:
    """Add, for each (new column: column) of ``values``, the maximum over the rows of the same
    ``parts`` up to this one by ``order`` (whole numbers; rows of the same number all count).  Null
    values don't count; null parts are one; rows without an order come first."""
    blocked = df.withColumn("_tm_block", F.floor(F.col(order) / size))
    tops = blocked.groupBy(*parts, "_tm_block").agg(*[F.max(v).alias(f"_tm_{n}") for n, v in values.items()])
    before = Window.partitionBy(*parts).orderBy("_tm_block").rowsBetween(Window.unboundedPreceding, -1)
    heads = tops.select(*[F.col(p).alias(f"_tm_p{i}") for i, p in enumerate(parts)], F.col("_tm_block").alias("_tm_at"),
                        *[F.max(f"_tm_{n}").over(before).alias(f"_tm_{n}") for n in values])
    here = F.col("_tm_block").eqNullSafe(F.col("_tm_at"))
    for i, p in enumerate(parts):
        here = here & F.col(p).eqNullSafe(F.col(f"_tm_p{i}"))
    inside = Window.partitionBy(*parts, "_tm_block").orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return blocked.join(heads, here).select(
        *df.columns, *[F.greatest(F.col(f"_tm_{n}"), F.max(v).over(inside)).alias(n) for n, v in values.items()])


def mark(newest: Column, delay_seconds: float) -> Column:
    return minus_seconds(truncate_ms(newest), delay_seconds)


def partition_watermark(log: DataFrame, ts: str, part: str, off: str, delay_seconds: float,
                        block: int = BLOCK_OFFSETS, out: str = "partition_watermark") -> DataFrame:
    """Every record with its own partition's watermark once the record was read."""
    newest = running_max(log, [part], off, block, {"_tm_newest": ts})
    return newest.withColumn(out, mark(F.col("_tm_newest"), delay_seconds)).drop("_tm_newest")


def watermark_by_batch(log: DataFrame, ts: str, part: str, batch: str, delay_seconds: float, idle_batches: int,
                       block: int = BLOCK_BATCHES) -> DataFrame:
    """(batch, active, watermark, watermark_held) after each arrival batch, from the first to the
    last: partitions that aren't idle, the log's watermark, and what it were without the idle rule.
    A record without an event time shows that its partition isn't idle, and moves no watermark."""
    arrived = log.where(F.col(batch).isNotNull())
    per = arrived.groupBy(part, batch).agg(F.max(ts).alias("newest"))
    last = arrived.agg(F.max(batch)).scalar()
    span = per.groupBy(part).agg(F.min(batch).alias("first")).select(
        F.col(part).alias("_tm_part"), F.explode(F.sequence(F.col("first"), last)).alias("_tm_batch"))
    grid = span.join(per, F.col("_tm_part").eqNullSafe(F.col(part)) & (F.col("_tm_batch") == F.col(batch)), "left").select(
        "_tm_part", "_tm_batch", "newest", F.col(batch).alias("seen"))
    known = running_max(grid, ["_tm_part"], "_tm_batch", block, {"upto": "newest", "last_seen": "seen"})
    active = F.col("_tm_batch") - F.col("last_seen") < idle_batches
    least = known.groupBy("_tm_batch").agg(
        F.count_if(active).alias("active"), F.min(F.when(active, F.col("upto"))).alias("low"), F.min("upto").alias("low_held"))
    marks = running_max(least, [], "_tm_batch", block, {"high": "low", "high_held": "low_held"})
    return marks.select(F.col("_tm_batch").alias(batch), "active", mark(F.col("high"), delay_seconds).alias("watermark"),
                        mark(F.col("high_held"), delay_seconds).alias("watermark_held"))


def late_by_watermark(log: DataFrame, trace: DataFrame, ts: str, batch: str, width: str) -> DataFrame:
    """Every record with its window and is_late: its window had closed under the log's watermark
    before its batch arrived.  Without an event time: no window, not late."""
    before = trace.select((F.col(batch) + 1).alias("_tm_next"), F.col("watermark").alias("_tm_mark"))
    there = F.col(ts).isNotNull()
    w = F.window(F.coalesce(F.col(ts), F.lit(0).cast("timestamp")), width)
    rows = log.withColumn("_tm_w", w).select("*", F.when(there, F.col("_tm_w.start")).alias("window_start"),
                                             F.when(there, F.col("_tm_w.end")).alias("window_end")).drop("_tm_w")
    late = F.coalesce(F.col("window_end") <= F.col("_tm_mark"), F.lit(False))
    return rows.join(before, F.col(batch) == F.col("_tm_next"), "left").withColumn("is_late", late).drop("_tm_next", "_tm_mark")


def closed_counts(rows: DataFrame, trace: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts of the rows that aren't late, in windows closed after the last batch: window_start,
    window_end, ``keys``, ride_count, held (whether it would still be open without the idle rule)."""
    end, held = (trace.agg(F.max(c)).scalar() for c in ("watermark", "watermark_held"))
    counts = rows.where(~F.col("is_late") & F.col("window_end").isNotNull()).groupBy("window_start", "window_end", *keys) \
        .agg(F.count(F.lit(1)).alias("ride_count"))
    return counts.where(F.col("window_end") <= end).withColumn("held", ~F.coalesce(F.col("window_end") <= held, F.lit(False)))
