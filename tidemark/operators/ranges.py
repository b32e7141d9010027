"""Figures over ranges of time: counter rates over a sliding range, grids that hold the last value.

Series are cut into blocks of time, so that a series with very many samples is many tasks' work.
Samples are first added up by pane: a range begins and ends between panes, so its rate takes a
few rows however dense the samples are.  A rate's range may begin before its block: each block
also gets the panes of the last range before it (a halo).  A held value may be older than its block: it is carried over the blocks, one
row a block.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECOND = 1_000_000
#: Seconds of a block of a rate, and steps of a block of a grid.
BLOCK_SECONDS, BLOCK_STEPS = 3600, 4096


def _floor(us: Column, size: int) -> Column:
    return ((us - F.pmod(us, F.lit(size))) / F.lit(size)).cast("bigint")


def _increase(now: Column, before: Column) -> Column:
    """Of a counter between two samples; a drop is a reset."""
    return F.when(before.isNull(), F.lit(None)).when(now < before, now).otherwise(now - before)


def _instant(us: Column) -> Column:
    return F.timestamp_micros(us)


def rate_at_steps(samples: DataFrame, series: Sequence[str], ts: str, value: str, seconds: int, step: int,
                  block: int = BLOCK_SECONDS) -> DataFrame:
    """Per-second rate of a counter over the last ``seconds`` at every step (a multiple of ``step``
    seconds) that has two samples in its range (s - seconds, s]: (series..., ts, rate).

    rate = increases between consecutive samples in the range / time between its first and last; a
    drop is a reset, the increase is then the new value.  No extrapolation to the range's ends.
    Samples of one series and time are one, the greatest; those without a time or value are none;
    a null label is a label."""
    size, span, grid = max(block, seconds) * SECOND, seconds * SECOND, step * SECOND
    # ranges begin and end between panes, so a range is a few panes, however many samples these have
    pane = gcd(step, seconds, block) * SECOND
    one = samples.where(F.col(ts).isNotNull() & F.col(value).isNotNull()).groupBy(*series, F.unix_micros(ts).alias("_tm_at")) \
        .agg(F.max(value).alias("_tm_v")).withColumn("_tm_us", _floor(F.col("_tm_at") + pane - 1, pane) * pane)
    previous = F.lag("_tm_v").over(Window.partitionBy(*series, "_tm_us").orderBy("_tm_at"))
    one = one.withColumn("_tm_up", _increase(F.col("_tm_v"), previous))
    ends = F.struct("_tm_at", "_tm_v")
    panes = one.groupBy(*series, "_tm_us").agg(
        F.min(ends).alias("_tm_first"), F.max(ends).alias("_tm_last"), F.sum("_tm_up").alias("_tm_inside"))
    us = F.col("_tm_us")
    home = _floor(us, size)
    # the next block's ranges reach back into this one's end
    in_halo = F.when(us > (home + 1) * size - span, home + 1)
    points = panes.withColumn("_tm_b", F.explode(F.array_compact(F.array(home, in_halo)))).withColumn("_tm_step", F.lit(False))
    # steps whose range holds the pane
    first = _floor(us + grid - 1, grid) * grid
    steps = panes.select(*series, F.explode(F.sequence(first, first + span, F.lit(grid))).alias("_tm_s"), us.alias("_tm_end")) \
        .where(F.col("_tm_s") <= F.col("_tm_end") - pane + span).select(*series, F.col("_tm_s").alias("_tm_us")).distinct() \
        .withColumn("_tm_b", _floor(us, size)).withColumn("_tm_step", F.lit(True))
    rows = points.unionByName(steps, allowMissingColumns=True)
    before = F.last("_tm_last", ignorenulls=True).over(Window.partitionBy(*series, "_tm_b").orderBy("_tm_us", "_tm_step").rowsBetween(
        Window.unboundedPreceding, -1))["_tm_v"]
    sample = ~F.col("_tm_step")
    rows = rows.withColumn("_tm_enter", F.when(sample, _increase(F.col("_tm_first")["_tm_v"], before)))
    back = Window.partitionBy(*series, "_tm_b").orderBy("_tm_us").rangeBetween(-(span - 1), Window.currentRow)
    # the increase into the first pane lies before the range
    lead = F.first(F.when(sample, F.struct("_tm_enter")), ignorenulls=True).over(back)["_tm_enter"]
    none = F.lit(0).cast(one.schema["_tm_v"].dataType)
    rise = F.coalesce(F.sum("_tm_inside").over(back), none) + F.coalesce(F.sum("_tm_enter").over(back), none) - F.coalesce(lead, none)
    time = F.max("_tm_last").over(back)["_tm_at"] - F.min("_tm_first").over(back)["_tm_at"]
    out = rows.select(*series, _instant(us).alias(ts), "_tm_step", rise.alias("_tm_rise"), time.alias("_tm_time"))
    return out.where(F.col("_tm_step") & (F.col("_tm_time") > 0)).select(
        *series, ts, (F.col("_tm_rise") / (F.col("_tm_time") / F.lit(SECOND))).alias("rate"))


def held_grid(samples: DataFrame, series: Sequence[str], ts: str, value: str, step: int, stale: int, tie: str | None = None,
              block: int = BLOCK_STEPS) -> DataFrame:
    """Every series at every step (multiples of ``step`` seconds) from the first to the last sample
    of all: (series..., ts, value), the last value at or before the step, null where it is ``stale``
    seconds old or older, or there is none yet.  Samples of one time: the greatest ``tie`` (else
    value) counts.  Samples without a time are none; a null value is a value; a null label is one."""
    grid = step * SECOND
    us = F.unix_micros(ts)
    place = F.struct(us.alias("us"), (F.col(tie) if tie else F.col(value)).alias("tie"), F.col(value).alias("v"))
    # the first step at or after a sample sees it; only the last sample of a step counts
    k = _floor(us + grid - 1, grid)
    last = samples.where(F.col(ts).isNotNull()).groupBy(*series, k.alias("_tm_k")).agg(F.max(place).alias("_tm_last"))
    last = last.withColumn("_tm_b", _floor(F.col("_tm_k"), block))
    k0, k1 = (last.agg(f("_tm_k")).scalar() for f in (F.min, F.max))
    tops = last.groupBy(*series, "_tm_b").agg(F.max("_tm_last").alias("_tm_top"))
    every = last.select(*series).distinct().withColumn("_tm_b", F.explode(F.sequence(_floor(k0, block), _floor(k1, block))))
    names = {c: f"_tm_s{i}" for i, c in enumerate(series)}
    tops = tops.select(*[F.col(c).alias(n) for c, n in names.items()], F.col("_tm_b").alias("_tm_at"), "_tm_top")
    here = F.col("_tm_b") == F.col("_tm_at")
    for c, n in names.items():
        here = here & F.col(c).eqNullSafe(F.col(n))
    past = Window.partitionBy(*series).orderBy("_tm_b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = every.join(tops, here, "left").select(*series, "_tm_b", F.max("_tm_top").over(past).alias("_tm_carry"))
    begin = F.greatest(F.col("_tm_b") * block, k0)
    end = F.least(F.col("_tm_b") * block + block - 1, k1)
    kind = last.schema["_tm_last"].dataType
    steps = blocks.select(*series, "_tm_b", F.explode(F.sequence(begin, end)).alias("_tm_k"), F.lit(None).cast(kind).alias("_tm_last"),
                          "_tm_carry", F.lit(True).alias("_tm_step"))
    rows = steps.unionByName(last.select(*series, "_tm_b", "_tm_k", "_tm_last", F.lit(None).cast(kind).alias("_tm_carry"),
                                         F.lit(False).alias("_tm_step")))
    upto = Window.partitionBy(*series, "_tm_b").orderBy("_tm_k").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    held = F.coalesce(F.last("_tm_last", ignorenulls=True).over(upto), F.col("_tm_carry"))
    out = rows.withColumn("_tm_held", held).where("_tm_step")
    now = F.col("_tm_k") * grid
    return out.select(*series, _instant(now).alias(ts), F.when(F.col("_tm_held.us") > now - stale * SECOND, F.col("_tm_held.v")).alias(value))
