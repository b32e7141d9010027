import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, rows
from tidemark.operators import eventtime
from tidemark.sources import relations as rel

T0 = dt.datetime(2026, 9, 23, 12, 0, 0)


def _events(spark, spec):
    """spec: (city, seconds after T0, batch)"""
    data = [(i, c, T0 + dt.timedelta(seconds=s), b) for i, (c, s, b) in enumerate(spec)]
    return spark.createDataFrame(data, "ride_id int, city string, t timestamp_ntz, batch int") \
        .withColumn("event_time", F.col("t").cast("timestamp")).drop("t")


def test_close_boundary_batch(spark):
    early = _events(spark, [("X", 0, 0), ("P", 14.999, 1)])
    on = _events(spark, [("X", 0, 0), ("P", 15.0, 1)])
    assert eventtime.tumble_count_closed(early, "event_time", ["city"], "10 seconds", 5).count() == 0
    got = eventtime.tumble_count_closed(on, "event_time", ["city"], "10 seconds", 5)
    assert rows(got, "city", "ride_count") == [("X", 1)]


def test_late_filter_lag(spark):
    df = _events(spark, [("X", 0, 0), ("P", 15, 1), ("X", 1, 2)])
    kept = eventtime.late_drop_count(df, "event_time", "batch", "10 seconds", 5, lag=2).first()
    assert (kept.kept_rows, kept.dropped_rows) == (3, 0)
    ideal = eventtime.late_drop_count(df, "event_time", "batch", "10 seconds", 5, lag=1).first()
    assert (ideal.kept_rows, ideal.dropped_rows) == (2, 1)


def test_late_rows_keep_open_window(spark):
    # a row older than the watermark whose window is still open is kept
    df = _events(spark, [("X", 9, 0), ("X", 12, 1), ("X", 13, 2), ("X", 5, 3)])
    c = eventtime.late_classify(df, "event_time", "batch", "10 seconds", 5, lag=1)
    assert rows(c.where("batch = 3"), "is_late") == [(False,)]


def test_tumble_closed_matches_brute_force(spark):
    r = rel.rides(spark, SF_SMALL).select("pickup_city", "event_time").collect()
    mx = max(x.event_time for x in r)
    wm = mx.replace(microsecond=mx.microsecond // 1000 * 1000) - dt.timedelta(seconds=5)
    brute = {}
    for x in r:
        start = x.event_time.replace(microsecond=0, minute=0, second=0)
        end = start + dt.timedelta(hours=1)
        if end <= wm:
            brute[(start, x.pickup_city)] = brute.get((start, x.pickup_city), 0) + 1
    got = eventtime.tumble_count_closed(rel.rides(spark, SF_SMALL), "event_time",
                                        ["pickup_city"], "1 hour", 5).collect()
    assert {(g.window_start, g.pickup_city): g.ride_count for g in got} == brute


def test_watermark_trace_null_head(spark):
    f = rel.feed(spark, SF_SMALL)
    t = eventtime.watermark_trace(f, "event_time", "batch", 5).orderBy("batch").collect()
    assert t[0].watermark is None and t[1].watermark is None
    assert t[2].watermark is not None
