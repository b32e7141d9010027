import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, rows, srt
from tidemark.operators import delivery, eventtime
from tidemark.plans.queries import QUERIES
from tidemark.session import fresh_dir
from tidemark.sources import relations as rel
from tidemark.streaming import dedup as sdedup
from tidemark.streaming import runner, windows

BASE = dt.datetime(2026, 9, 23, 12, 0, 1)
SCHEMA = "ride_id int, pickup_city string, event_time timestamp, batch int"


def _feed(spark, spec, base=BASE):
    data = [(i, c, base + dt.timedelta(seconds=s), i) for i, (c, s) in enumerate(spec)]
    df = spark.createDataFrame(
        [(a, b, t, d) for a, b, t, d in data],
        "ride_id int, pickup_city string, t timestamp_ntz, batch int")
    return df.select("ride_id", "pickup_city", F.col("t").cast("timestamp").alias("event_time"),
                     "batch")


def _ntz(df):
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c.startswith("window")
                       else F.col(c) for c in df.columns])


LATE_DEMO = [("Capital", 0), ("Capital", 2), ("Capital", 4),
             ("Shelby", 64), ("Shelby", 74), ("Shelby", 84),
             ("Capital", -26), ("Capital", 3), ("Shelby", 94)]


def test_late_replay_fixture(spark):
    f = _feed(spark, LATE_DEMO)
    run = windows.late_replay(f, "event_time", ["pickup_city"], "batch", "10 seconds", 5)
    got = rows(_ntz(run.output), "window_start", "pickup_city", "ride_count")
    t = dt.datetime(2026, 9, 23, 12, 0)
    assert got == srt([(t, "Capital", 3),
                       (t + dt.timedelta(seconds=60), "Shelby", 1),
                       (t + dt.timedelta(seconds=70), "Shelby", 1),
                       (t + dt.timedelta(seconds=80), "Shelby", 1)])
    dropped = sum(o.get("numRowsDroppedByWatermark", 0)
                  for p in run.progress for o in p.get("stateOperators") or [])
    assert dropped == 2
    # the batch operator says the same about late rows, and about the output
    late = eventtime.late_drop_count(f, "event_time", "batch", "10 seconds", 5).first()
    assert (late.kept_rows, late.dropped_rows) == (7, 2)
    batch = eventtime.late_kept_closed(f, "event_time", ["pickup_city"], "batch", "10 seconds", 5)
    assert rows(_ntz(batch)) == rows(_ntz(run.output))


def test_close_boundary_stream(spark):
    for p_at, expect in ((14.999, 0), (15.0, 1)):
        f = _feed(spark, [("X", -1), ("P", p_at - 1)])
        run = windows.late_replay(f, "event_time", ["pickup_city"], "batch", "10 seconds", 5)
        assert run.output.count() == expect


def test_late_filter_lag_stream(spark):
    f = _feed(spark, [("X", -1), ("P", 14), ("X", 0), ("Q", 100)])
    run = windows.late_replay(f, "event_time", ["pickup_city"], "batch", "10 seconds", 5)
    got = {r.pickup_city: r.ride_count for r in run.output.collect()}
    assert got["X"] == 2


def test_two_sources_one_quiet(spark):
    t0 = dt.datetime(2026, 9, 23, 0, 0, 0)
    a = spark.createDataFrame([(1, "c", t0 + dt.timedelta(seconds=1)),
                               (2, "c", t0 + dt.timedelta(hours=1))],
                              "ride_id int, pickup_city string, event_time timestamp")
    b = spark.createDataFrame([(3, "c", t0 + dt.timedelta(seconds=2))],
                              "ride_id int, pickup_city string, event_time timestamp")
    pa, pb = runner.stage(a, "srcA"), runner.stage(b, "srcB")
    out = {}
    before = spark.conf.get(windows.POLICY_CONF)
    for policy in ("min", "max"):
        run = windows.union_count(
            lambda s: [runner.file_stream(s, pa, a.schema), runner.file_stream(s, pb, b.schema)],
            spark, "event_time", ["pickup_city"], "10 seconds", 5, policy, label="two")
        out[policy] = [(r.pickup_city, r.ride_count) for r in run.output.collect()]
    assert spark.conf.get(windows.POLICY_CONF) == before
    assert out == {"min": [], "max": [("c", 2)]}


def test_stream_dedup_restart(spark):
    src = fresh_dir(spark, "dedup-src")
    schema = "ride_id string, n int"
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], schema) \
        .coalesce(1).write.parquet(src)
    ckpt, sink = fresh_dir(spark, "ckpt"), fresh_dir(spark, "sink")
    s = runner.file_stream(spark, src, spark.createDataFrame([], schema).schema)
    run1 = runner.run_available_now(sdedup.dedup(s, ["ride_id"]), "d", checkpoint=ckpt,
                                    sink_path=sink)
    assert rows(run1.output, "ride_id") == srt([("a",), ("b",), (None,)])
    spark.createDataFrame([("a", 6), ("c", 7)], schema).coalesce(1).write.mode("append").parquet(src)
    s = runner.file_stream(spark, src, spark.createDataFrame([], schema).schema)
    run2 = runner.run_available_now(sdedup.dedup(s, ["ride_id"]), "d", checkpoint=ckpt,
                                    sink_path=sink)
    assert rows(run2.output, "ride_id") == srt([("a",), ("b",), (None,), ("c",)])
    dropped = [o.get("customMetrics", {}).get("numDroppedDuplicateRows")
               for p in run2.progress for o in p.get("stateOperators") or []]
    assert 1 in dropped


def test_stream_dedup_bounded_forgets(spark):
    t0 = dt.datetime(2026, 9, 23, 0, 0, 0)
    # state is evicted at the end of a micro-batch with the previous batch's
    # watermark, so the key is forgotten one batch after the watermark passes
    df = spark.createDataFrame([("a", t0, 0), ("b", t0 + dt.timedelta(minutes=10), 1),
                                ("c", t0 + dt.timedelta(minutes=10), 2),
                                ("a", t0 + dt.timedelta(minutes=10, seconds=1), 3)],
                               "ride_id string, event_time timestamp, batch int")
    replay = windows.replay_batches(df.repartition(3), "batch", "bounded")
    s = runner.file_stream(spark, replay.path, df.schema, max_files=replay.files_per_trigger)
    run = runner.run_available_now(sdedup.dedup_bounded(s, ["ride_id"], "event_time", "1 minute"),
                                   "bounded")
    assert rows(run.output, "ride_id") == [("a",), ("a",), ("b",), ("c",)]


def test_parity_stream_and_batch_windows(spark):
    stream = QUERIES["stream_tumble_count"](spark, SF_SMALL)
    r = rel.rides(spark, SF_SMALL)
    batch = eventtime.tumble_count_closed(r, "event_time", ["status"], "10 seconds", 5)
    assert rows(stream) == rows(_ntz(batch))


def test_parity_stream_and_batch_dedup(spark):
    stream = QUERIES["stream_dedup"](spark, SF_SMALL)
    d = rel.deliveries(spark, SF_SMALL).select("ride_id", "part", "off")
    batch = delivery.keep_first(d, "ride_id", ["part", "off"]).select("ride_id")
    assert rows(stream) == rows(batch)


def test_stream_contract_split_is_exactly_once(spark):
    import json
    from tidemark.operators import schemas
    from tidemark.streaming import contracts as scontracts
    v1 = schemas.Contract.parse(schemas.RIDE_V1)
    good = {"ride_id": "a", "rider_name": "n", "pickup_city": "c", "dropoff_city": "d",
            "fare": 1.0, "status": "s", "event_time": "t"}
    src = fresh_dir(spark, "split-src")
    spark.createDataFrame([(json.dumps(good),), ("junk",)], "value string") \
        .coalesce(1).write.parquet(src)
    schema = spark.read.parquet(src).schema
    ckpt, acc, qua = fresh_dir(spark, "c"), fresh_dir(spark, "a"), fresh_dir(spark, "q")
    for _ in range(2):  # a rerun over the same checkpoint adds nothing
        scontracts.split_stream(runner.file_stream(spark, src, schema), "value", v1,
                                checkpoint=ckpt, accepted_path=acc, quarantine_path=qua)
    assert spark.read.parquet(acc).count() == 1
    bad = spark.read.parquet(qua).collect()
    assert len(bad) == 1 and list(bad[0].violations) == ["malformed"]
    # a batch that runs again overwrites its own folder
    spark.createDataFrame([(json.dumps(good),)], "value string").write.mode("overwrite") \
        .parquet(f"{acc}/batch_id=0")
    assert spark.read.parquet(acc).count() == 1


def test_progress_rows_of_replay(spark):
    from tidemark.streaming import progress
    f = _feed(spark, LATE_DEMO)
    run = windows.late_replay(f, "event_time", ["pickup_city"], "batch", "10 seconds", 5)
    p = progress.progress_rows(spark, run.progress).orderBy("batch_id").collect()
    data = [r for r in p if r.num_input_rows > 0]
    assert len(data) == len(LATE_DEMO)
    assert all(r.observed_rows == 1 for r in data)
    assert sum(r.num_dropped_by_watermark for r in p) == 2
    assert p[-1].watermark == dt.datetime(2026, 9, 23, 12, 1, 30)


def test_replay_pads_batches_to_equal_file_counts(spark):
    import os
    rows_ = [(i, "c", dt.datetime(2026, 9, 23) + dt.timedelta(seconds=i), 0) for i in range(40)]
    rows_ += [(100, "c", dt.datetime(2026, 9, 23, 1), 1)]
    rows_ += [(200 + i, "c", dt.datetime(2026, 9, 23, 2) + dt.timedelta(seconds=i), 2)
              for i in range(7)]
    df = spark.createDataFrame(rows_, "ride_id int, pickup_city string, t timestamp_ntz, batch int") \
        .select("ride_id", "pickup_city", F.col("t").cast("timestamp").alias("event_time"), "batch") \
        .repartition(5)
    replay = windows.replay_batches(df, "batch", "pad")
    assert replay.files_per_trigger > 1
    local = replay.path.replace("file:", "")
    counts = [len([f for f in os.listdir(f"{local}/batch={b}") if f.endswith(".parquet")])
              for b in (0, 1, 2)]
    assert counts == [replay.files_per_trigger] * 3
    s = runner.file_stream(spark, replay.path, df.schema, max_files=replay.files_per_trigger)
    run = runner.run_available_now(s.select("ride_id"), "pad")
    inputs = [p["numInputRows"] for p in run.progress if p["numInputRows"]]
    assert inputs == [40, 1, 7]
    assert run.output.count() == 48


def test_staged_files_are_small_and_batches_take_many(spark, monkeypatch):
    """One file is one task's work: the split's staged table has many files however its rows are parted."""
    from tidemark.plans import queries
    from tidemark.sources import relations as rel
    d = spark.range(1000).coalesce(1)
    path = runner.stage(d, "small-files", file_rows=100)
    assert len(spark.read.parquet(path).inputFiles()) == 10 and spark.read.parquet(path).count() == 1000
    staged, whole = [], runner.stage
    monkeypatch.setattr(queries, "SPLIT_FILE_ROWS", 100)
    monkeypatch.setattr(runner, "stage", lambda *a, **k: staged.append(whole(*a, **k)) or staged[-1])
    out = queries.QUERIES["stream_contract_split"](spark, SF_SMALL)
    n = rel.rides(spark, SF_SMALL).count()
    assert out.count() == n and len(spark.read.parquet(staged[0]).inputFiles()) >= n // 100
