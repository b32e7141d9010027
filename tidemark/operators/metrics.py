"""Monitoring figures over metric samples (series labels, ts, value).

Samples are a table of (label columns..., ts, value).  Labels are plain
columns, not a map, so they can be grouping and join keys.  Every window is
partitioned by series and by a bounded time range (a day, a scrape step), so
no task ever holds a whole series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def step_start(ts: Column | str, step: str) -> Column:
    """Floor an instant to a fixed step (aligned on the epoch)."""
    return F.window(ts, step).start


def last_per_step(samples: DataFrame, series: Sequence[str], ts: str, value: str,
                  step: str, tie: str | None = None, out: str | None = None) -> DataFrame:
    """The last sample of each series in each step (a scrape grid):
    (series..., ts=step start, value as ``out``).  Ties on ts are broken by
    ``tie``.  Samples without a time are in no step."""
    out = out or value
    order = F.struct(ts, tie) if tie else F.struct(ts, value)
    g = samples.groupBy(*series, step_start(ts, step).alias("_tm_step")) \
        .agg(F.max_by(value, order).alias(out))
    return g.select(*series, F.col("_tm_step").alias(ts), out)


def latest(samples: DataFrame, series: Sequence[str], ts: str, value: str,
           tie: str | None = None) -> DataFrame:
    """Current value of each series: (series..., latest_ts, latest_value)."""
    order = F.struct(ts, tie) if tie else F.struct(ts, value)
    return samples.groupBy(*series).agg(F.max(ts).alias("latest_ts"),
                                        F.max_by(value, order).alias("latest_value"))


def gauge_sum(samples: DataFrame, series: Sequence[str], ts: str, value: str,
              out: str = "total") -> DataFrame:
    """Sum over series of each series' latest value (one row)."""
    last = latest(samples, series, ts, value)
    return last.agg(F.sum("latest_value").cast("bigint").alias(out))


def in_last(df: DataFrame, ts: str, seconds: int) -> DataFrame:
    """Rows newer than max(ts) - range (a dashboard's time range)."""
    newest = df.select(F.max(ts)).scalar()
    return df.where(F.col(ts) > newest - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                            F.lit(seconds)))


def counter_rate(samples: DataFrame, series: Sequence[str], ts: str, value: str,
                 range_col: str) -> DataFrame:
    """Per-second rate of a counter per series and range.

    rate = (sum of increases between consecutive samples in the range) /
    (last ts - first ts); a drop is a counter reset, so the increase is the
    new value.  Fewer than two samples, or no time between them, -> null.
    (No extrapolation to the range ends.)
    """
    w = Window.partitionBy(*series, range_col).orderBy(ts)
    prev = F.lag(value).over(w)
    inc = F.when(prev.isNull(), F.lit(None)) \
        .when(F.col(value) < prev, F.col(value)).otherwise(F.col(value) - prev)
    d = samples.withColumn("_tm_inc", inc)
    g = d.groupBy(*series, range_col).agg(
        F.sum("_tm_inc").alias("_tm_incr"),
        ((F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))) / F.lit(1e6)).alias("_tm_span"))
    rate = F.when(F.col("_tm_span") > 0, F.col("_tm_incr") / F.col("_tm_span"))
    return g.select(*series, range_col, rate.alias("rate"))


def consumer_lag(end_offsets: DataFrame, assignments: DataFrame) -> DataFrame:
    """Lag per (grp, topic, part) = end offset - committed offset.

    ``assignments`` has one row per partition a group is assigned
    (grp, topic, part, committed), with a null ``committed`` where the group
    has not committed yet (lag is then null).  ``end_offsets`` is (topic,
    part, end_offset).  An equi-join on (topic, part), which AQE broadcasts
    where it measures a small side.
    """
    j = assignments.join(end_offsets, ["topic", "part"], "left")
    return j.select("grp", "topic", "part", "end_offset", "committed",
                    (F.col("end_offset") - F.col("committed")).alias("lag"))
