"""Bounded stream dedup with an outcome for every row, against a plain simulation."""

import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, rows, srt
from tidemark.session import STATE_STORE, session_with
from tidemark.streaming import runner
from tidemark.streaming.outcomes import dedup_outcomes

T0 = dt.datetime(2024, 1, 1)
DELAY, HORIZON = 15, 40


def plain(data):
    """(batch, key, seconds, id) -> Counter of (row, outcome)."""
    out, since, newest = Counter(), {}, None
    for b in sorted({r[0] for r in data}):
        mark = None if newest is None else newest - DELAY
        here = [r for r in data if r[0] == b]
        best = {}
        for r in here:
            if r[2] is not None and (mark is None or r[2] >= mark):
                known = r[1] in since and not (mark is not None and mark >= since[r[1]] + HORIZON)
                if not known:
                    best[r[1]] = min(best.get(r[1], r), r, key=lambda x: (x[2], str(x[3])))
        for r in here:
            kind = "untimed" if r[2] is None else "late" if mark is not None and r[2] < mark else "duplicate"
            if kind == "duplicate" and best.get(r[1]) == r and not out[r, "accepted"]:
                kind = "accepted"
            out[r, kind] += 1
        since |= {k: r[2] for k, r in best.items()}
        newest = max([r[2] for r in here if r[2] is not None] + [newest] * (newest is not None), default=None)
    return out


def test_every_row_has_an_outcome(spark):
    rng = random.Random(3)
    data = []
    for i in range(220):
        b = i // 55
        key = rng.choice(["hot"] * 6 + [None, "a", "b", "c", f"k{i}"])
        t = None if rng.random() < .05 else b * 30 + rng.randrange(-45, 30)
        data += [(b, key, t, i)] * rng.choice([1, 1, 1, 3])
    df = spark.createDataFrame([(b, k, None if t is None else T0 + dt.timedelta(seconds=t), i) for b, k, t, i in data],
                               "batch int, k string, ts timestamp, id int")
    beside = session_with(spark, spark__sql__shuffle__partitions="2")
    run = runner.run_in_arrivals(
        beside.createDataFrame(df.collect(), df.schema), "batch", lambda s: dedup_outcomes(s, ["k"], "ts", f"{DELAY} seconds", HORIZON), "outcomes")
    got = Counter()
    for r in run.output.collect():
        got[(r.batch, r.k, None if r.ts is None else int((r.ts - T0).total_seconds()), r.id), r.outcome] += r.copies
    want = plain(data)
    assert got == +want and sum(got.values()) == len(data)
    kinds = Counter(o for (_, o), n in want.items() for _ in range(n))
    assert min(kinds[o] for o in ("accepted", "duplicate", "late", "untimed")) >= 5
    assert max(n for (r, o), n in want.items() if r[1] == "hot" and o == "accepted") == 1
    again = [r for r, o in want if r[1] == "hot" and o == "accepted"]
    assert len(again) > 1  # forgotten, and accepted anew
    # keys whose horizon has passed hold no state
    state = run.progress[-1]["stateOperators"][0]["numRowsTotal"]
    assert 0 < state < len({r[1] for r, o in want if o == "accepted"})


def test_nothing_arrives(spark):
    df = spark.createDataFrame([], "batch int, k string, ts timestamp")
    run = runner.run_in_arrivals(df, "batch", lambda s: dedup_outcomes(s, ["k"], "ts", "1 second", 5), "outcomes")
    assert run.output.count() == 0 and run.output.columns == ["batch", "k", "ts", "copies", "outcome"]


def test_arrivals_keep_one_checkpoint(spark):
    df = spark.createDataFrame([(None, 1), (2, 2), (2, 3), (5, 4)], "batch int, v int")
    run = runner.run_in_arrivals(df, "batch", lambda s: s.withColumn("w", F.col("v") * 2), "arrivals")
    assert rows(run.output) == srt([(None, 1, 2), (2, 2, 4), (2, 3, 6), (5, 4, 8)])
    assert [p["numInputRows"] for p in run.progress if p["numInputRows"]] == [1, 2, 1]


def test_default_state_store_is_left_alone(spark):
    from tidemark.plans.queries import QUERIES
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    plain_session = session_with(spark, **{STATE_STORE.replace(".", "__"): default})
    out = QUERIES["stream_dedup_outcomes"](plain_session, SF_SMALL)
    events = plain_session.read.parquet(f"{SF_SMALL}/events.parquet")
    want = events.agg(F.sum(F.when(F.col("event_id") % 7 == 0, 2).otherwise(1))).first()[0]
    assert out.agg(F.sum("copies")).first()[0] == want
    assert plain_session.conf.get(STATE_STORE) == default


def test_processor_needs_no_package_on_workers():
    import subprocess
    import sys

    from pyspark import cloudpickle

    from tidemark.streaming.outcomes import KnownKeys
    read = "import sys, pickle; p = pickle.load(sys.stdin.buffer); assert 'tidemark' not in sys.modules; print(p.horizon_us)"
    got = subprocess.run([sys.executable, "-c", read], input=cloudpickle.dumps(KnownKeys(7)), capture_output=True, cwd="/", check=True)
    assert got.stdout.strip() == b"7"
