"""Event time on batch tables: tumbling counts, closed windows, watermark
trace and late-row classification.

Semantics (bounded out-of-orderness):
* watermark = max event time seen (millisecond precision) - delay; it moves
  only with data;
* a window [start, end) is closed once end <= watermark; closed windows are
  emitted once and never retracted;
* a row is late (dropped) when its window had closed before the row arrived.
  A row older than the watermark whose window is still open is kept.

Streaming jobs compute the watermark per micro-batch; here arrival batches are
an explicit column.  Spark filters late rows of batch b with the watermark
known at the end of batch b-2 and evicts with the one of b-1, so
``lag=2`` reproduces a one-batch-per-trigger replay; ``lag=1`` is the ideal
rule (everything that arrived before).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.codec import minus_seconds, truncate_ms


def tumble_count(df: DataFrame, ts: str, keys: Sequence[str], width: str,
                 count_col: str = "ride_count") -> DataFrame:
    """COUNT(*) per (tumbling window, keys); every window (batch form).

    Partial + final hash aggregation; the window bucket is a projection.  Rows
    without an event time are in no window (``late_drop_count`` counts them).
    """
    w = F.window(ts, width)
    g = df.where(F.col(ts).isNotNull()).groupBy(w.alias("w"), *keys) \
        .agg(F.count(F.lit(1)).alias(count_col))
    return g.select(F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"), *keys, count_col)


def final_watermark(df: DataFrame, ts: str, delay_seconds: float) -> Column:
    """The watermark after all of ``df``, as a scalar subquery column."""
    return df.select(minus_seconds(truncate_ms(F.max(ts)), delay_seconds)).scalar()


def closed_only(counts: DataFrame, watermark: Column) -> DataFrame:
    """Windows a streaming job would have emitted under ``watermark``."""
    return counts.where(F.col("window_end") <= watermark)


def tumble_count_closed(df: DataFrame, ts: str, keys: Sequence[str], width: str,
                        delay_seconds: float, watermark: Column | None = None) -> DataFrame:
    """Windows closed under the final watermark.

    By default the watermark is taken over ``df`` itself.  When ``df`` is the
    end of a long chain, pass the watermark of the source it came from (as a
    stream declares it on its source): that subquery scans one column of the
    source instead of running the chain a second time.
    """
    counts = tumble_count(df, ts, keys, width)
    wm = watermark if watermark is not None else final_watermark(df, ts, delay_seconds)
    return closed_only(counts, wm)


def watermark_trace(df: DataFrame, ts: str, batch_col: str, delay_seconds: float,
                    lag: int = 2) -> DataFrame:
    """Per arrival batch: its max event time and the watermark its late
    filter uses (max over batches up to ``lag`` before it, minus delay).

    The per-batch table has one row per arrival batch, so the running max is
    a window over that table, not over the events.  It is ordered in one task:
    fine for a million batches, too much for batches of a second over years.
    """
    per_batch = df.groupBy(batch_col).agg(F.max(ts).alias("batch_max"))
    upto = Window.orderBy(batch_col).rowsBetween(Window.unboundedPreceding, -lag)
    return per_batch.select(
        batch_col, "batch_max",
        minus_seconds(truncate_ms(F.max("batch_max").over(upto)), delay_seconds)
        .alias("watermark"))


def late_classify(df: DataFrame, ts: str, batch_col: str, width: str,
                  delay_seconds: float, lag: int = 2) -> DataFrame:
    """Every row with its window and ``is_late``.  The trace (one row per
    batch) is joined back on the batch; AQE broadcasts it when its measured
    size is small and falls back to a shuffle join when not.  A row without an
    event time stays, without a window and not late."""
    trace = watermark_trace(df, ts, batch_col, delay_seconds, lag) \
        .select(F.col(batch_col).alias("_tm_b"), "watermark")
    there = F.col(ts).isNotNull()
    w = F.window(F.coalesce(F.col(ts), F.lit(0).cast("timestamp")), width)
    rows = df.withColumn("_tm_w", w).select(
        "*", F.when(there, F.col("_tm_w.start")).alias("window_start"),
        F.when(there, F.col("_tm_w.end")).alias("window_end")).drop("_tm_w")
    j = rows.join(trace, rows[batch_col] == trace["_tm_b"], "left").drop("_tm_b")
    late = F.coalesce(F.col("window_end") <= F.col("watermark"), F.lit(False))
    return j.withColumn("is_late", late)


def late_drop_count(df: DataFrame, ts: str, batch_col: str, width: str,
                    delay_seconds: float, lag: int = 2) -> DataFrame:
    """One row: input rows kept, dropped as late (rows, not groups), and without
    an event time."""
    c = late_classify(df, ts, batch_col, width, delay_seconds, lag)
    there = F.col(ts).isNotNull()
    return c.agg(F.count_if(there & ~F.col("is_late")).alias("kept_rows"),
                 F.count_if(F.col("is_late")).alias("dropped_rows"),
                 F.count_if(~there).alias("no_event_time"))


def late_kept_closed(df: DataFrame, ts: str, keys: Sequence[str], batch_col: str,
                     width: str, delay_seconds: float, lag: int = 2) -> DataFrame:
    """What an append-mode stream emits over the arrival batches: counts of
    the kept rows, for windows closed by the final watermark."""
    c = late_classify(df, ts, batch_col, width, delay_seconds, lag).where(
        ~F.col("is_late") & F.col(ts).isNotNull())
    counts = c.groupBy("window_start", "window_end", *keys) \
        .agg(F.count(F.lit(1)).alias("ride_count"))
    return closed_only(counts, final_watermark(df, ts, delay_seconds))
