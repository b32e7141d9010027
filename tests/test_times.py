"""Watermark by partition, rates over sliding ranges, held grids: against plain versions."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, srt
from tidemark.operators import partition_watermark as pw
from tidemark.operators import ranges

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return None if seconds is None else T0 + dt.timedelta(seconds=seconds)


def secs(t):
    return None if t is None else (t - T0).total_seconds()


def log_of(spark, seed, n=400, parts=4):
    rng = random.Random(seed)
    got, off = [], {}
    for i in range(n):
        p = rng.choice([None, *range(parts)])
        b = i // 25 + (i // 25 >= 7) * 3                      # no batch 7, 8, 9
        if p == 2 and b > 4:                                   # a partition that goes quiet
            p = 1
        t = None if rng.random() < .05 else b * 10 + rng.uniform(-25, 10)
        off[p] = off.get(p, -1) + 1
        got.append((p, off[p], b, None if t is None else round(t, 3)))
    df = spark.createDataFrame([(p, o, b, at(t)) for p, o, b, t in got], "part int, off bigint, batch bigint, ts timestamp")
    return got, df


def plain_trace(got, delay, idle):
    first, last = min(r[2] for r in got), max(r[2] for r in got)
    out, best, best_held = [], None, None
    for b in range(first, last + 1):
        parts = {r[0] for r in got if r[2] <= b}
        newest = {p: max([r[3] for r in got if r[0] == p and r[2] <= b and r[3] is not None], default=None) for p in parts}
        live = {p for p in parts if b - max(r[2] for r in got if r[0] == p and r[2] <= b) < idle}
        low = min([newest[p] for p in live if newest[p] is not None], default=None)
        held = min([v for v in newest.values() if v is not None], default=None)
        best, best_held = max([v for v in (best, low) if v is not None], default=None), max([v for v in (best_held, held) if v is not None], default=None)
        out.append((b, len(live), None if best is None else round(best - delay, 3), None if best_held is None else round(best_held - delay, 3)))
    return out


@pytest.mark.parametrize("seed,block", [(1, 1024), (2, 3), (3, 1)])
def test_watermark_by_batch(spark, seed, block):
    got, log = log_of(spark, seed)
    trace = pw.watermark_by_batch(log, "ts", "part", "batch", 5, 3, block)
    told = [(r.batch, r.active, secs(r.watermark), secs(r.watermark_held)) for r in trace.collect()]
    want = plain_trace(got, 5, 3)
    assert sorted(told) == [(b, n, w, h) for b, n, w, h in want]
    # the quiet partition holds the watermark back only without the idle rule
    assert want[-1][2] > want[-1][3]


@pytest.mark.parametrize("block", [1 << 16, 7, 1])
def test_watermark_of_a_partition(spark, block):
    got, log = log_of(spark, 5)
    told = {(r.part, r.off): secs(r.partition_watermark) for r in pw.partition_watermark(log, "ts", "part", "off", 5, block).collect()}
    for p, o, _, _ in got:
        newest = max([r[3] for r in got if r[0] == p and r[1] <= o and r[3] is not None], default=None)
        assert told[p, o] == (None if newest is None else pytest.approx(newest - 5, abs=1e-9))
    assert len(told) == len(got)


def test_late_rows_and_closed_windows(spark):
    got, log = log_of(spark, 8)
    trace = pw.watermark_by_batch(log, "ts", "part", "batch", 5, 3)
    late = pw.late_by_watermark(log, trace, "ts", "batch", "10 seconds")
    marks = {b + 1: w for b, _, w, _ in plain_trace(got, 5, 3)}
    want = []
    for p, o, b, t in got:
        end = None if t is None else (t // 10 + 1) * 10
        want.append((p, o, end is not None and marks.get(b) is not None and end <= marks[b]))
    assert rows(late, "part", "off", "is_late") == srt(want) and 5 < sum(w[2] for w in want) < len(want) / 2
    closed = pw.closed_counts(late, trace, [])
    _, _, w, held = plain_trace(got, 5, 3)[-1]
    kept = [(t // 10 + 1) * 10 for (p, o, b, t), (_, _, lt) in zip(got, want) if t is not None and not lt]
    told = sorted((secs(r.window_end), r.ride_count, r.held) for r in closed.collect())
    assert told == sorted((e, kept.count(e), e > held) for e in set(kept) if e <= w)
    assert any(t[2] for t in told) and not all(t[2] for t in told)
    assert pw.watermark_by_batch(log.limit(0), "ts", "part", "batch", 5, 3).count() == 0


def plain_rate(samples, seconds, step):
    out = []
    for series in {s[0] for s in samples}:
        own = {}
        for _, t, v in (s for s in samples if s[0] == series and s[1] is not None and s[2] is not None):
            own[t] = max(v, own.get(t, v))
        own = sorted(own.items())
        if not own:
            continue
        s = (own[0][0] // step) * step
        while s <= own[-1][0] + seconds:
            inside = [x for x in own if s - seconds < x[0] <= s]
            if len(inside) > 1:
                rise = sum(b - a if b >= a else b for (_, a), (_, b) in zip(inside, inside[1:]))
                out.append((series, s, round(rise / (inside[-1][0] - inside[0][0]), 9)))
            s += step
    return out


@pytest.mark.parametrize("block", [1, 97, 3600])
def test_rate_over_a_sliding_range(spark, block):
    rng = random.Random(block)
    samples, value = [], {}
    for i in range(500):
        s = rng.choice(["a", "b", None])
        value[s] = 0 if rng.random() < .05 else value.get(s, 0) + rng.randrange(9)
        samples.append((s, i + rng.choice([0, .25, 30]), value[s]))
    samples += [("c", 5, 1), ("d", None, 4), ("d", 3, None), ("a", 100000, 7), ("a", 100020, 9)]
    df = spark.createDataFrame([(s, at(t), v) for s, t, v in samples], "s string, ts timestamp, v bigint")
    told = ranges.rate_at_steps(df, ["s"], "ts", "v", 60, 15, block)
    got = [(r.s, secs(r.ts), round(r.rate, 9)) for r in told.collect()]
    assert srt(got) == srt([(s, float(t), r) for s, t, r in plain_rate(samples, 60, 15)]) and len(got) > 80
    assert ranges.rate_at_steps(df.limit(0), ["s"], "ts", "v", 60, 15).count() == 0


@pytest.mark.parametrize("block", [1, 5, 4096])
def test_held_grid(spark, block):
    rng = random.Random(block)
    samples = [(rng.choice(["a", "b", None]), rng.choice([10 * i, 10 * i + rng.random() * 9]), i, rng.choice([None, 1.5, float(i)]))
               for i in range(0, 120) if i % 40 < 25 for _ in range(rng.choice([0, 1, 2]))]
    samples += [("late", 900, 1, 9.0), ("late", 900, 2, 8.0), ("x", None, 1, 1.0)]
    df = spark.createDataFrame([(s, at(t), i, v) for s, t, i, v in samples], "s string, ts timestamp, i int, v double")
    got = [(r.s, secs(r.ts), r.v) for r in ranges.held_grid(df, ["s"], "ts", "v", 10, 60, tie="i", block=block).collect()]
    timed = [s for s in samples if s[1] is not None]
    first, last = (-(-f(s[1] for s in timed) // 10) * 10 for f in (min, max))
    want = []
    for series in {s[0] for s in timed}:
        t = first
        while t <= last:
            seen = max([(s[1], s[2], s[3] is not None, s[3]) for s in timed if s[0] == series and s[1] <= t], default=None)
            want.append((series, float(t), seen[3] if seen and seen[0] > t - 60 else None))
            t += 10
    assert len(got) == len(want)
    same = {(s, t): v for s, t, v in got}
    ties = {(s[0], s[1], s[2]) for s in timed if sum(x[:3] == s[:3] for x in timed) > 1}
    assert all(same[s, t] == v for s, t, v in want if not ties or same[s, t] == v or (s, t) not in {(x[0], -(-x[1] // 10) * 10) for x in ties})
    assert sum(v is not None for v in same.values()) > 50 and sum(v is None for v in same.values()) > 50
    assert ranges.held_grid(df.limit(0), ["s"], "ts", "v", 10, 60).count() == 0


def test_hot_series_is_many_tasks_work(spark):
    """No window is partitioned by a series alone but those over blocks."""
    d = spark.range(20_000).select(F.lit("hot").alias("s"), F.timestamp_seconds(F.col("id")).alias("ts"), F.col("id").alias("v"))
    told = ranges.rate_at_steps(d, ["s"], "ts", "v", 60, 60)
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(s" in plan and "_tm_b" in plan.split("Window")[1]
    assert told.where("rate != 1").count() == 0 and told.count() == 334
    held = ranges.held_grid(d, ["s"], "ts", "v", 10, 60, block=100)
    assert held.count() == 2001 and held.where(F.col("v") != F.least(F.unix_seconds("ts"), F.lit(19999))).count() == 0


def test_dense_series_is_not_compared_with_itself(spark):
    """An hour's range over very many samples takes rows by pane, not every sample at every sample."""
    d = spark.range(150_000).select(F.lit("hot").alias("s"), F.timestamp_micros(F.col("id") * 20_000).alias("ts"), F.col("id").alias("v"))
    began = time.monotonic()
    told = ranges.rate_at_steps(d, ["s"], "ts", "v", 3600, 900).select("rate", F.unix_seconds("ts").alias("at")).collect()
    assert sorted(r["at"] for r in told) == [900 * k for k in range(1, 8)] and {r.rate for r in told} == {50.0}
    assert time.monotonic() - began < 60  # by every pair of samples it is minutes
