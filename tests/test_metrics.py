import datetime as dt

from tests.conftest import rows, srt
from tidemark.operators import metrics

T0 = dt.datetime(2024, 1, 1)


def _s(spark, data):
    return spark.createDataFrame(
        [(t, p, T0 + dt.timedelta(seconds=s), float(v), "d") for t, p, s, v in data],
        "topic string, part int, ts timestamp, value double, day string")


def test_counter_rate_with_reset(spark):
    s = _s(spark, [("a", 0, 0, 10), ("a", 0, 10, 20), ("a", 0, 20, 5), ("a", 0, 30, 15),
                   ("b", 0, 0, 1)])
    got = {r.topic: r.rate for r in
           metrics.counter_rate(s, ["topic", "part"], "ts", "value", "day").collect()}
    assert got["a"] == (10 + 5 + 10) / 30
    assert got["b"] is None


def test_consumer_lag_missing_commit_is_null(spark):
    ends = spark.createDataFrame([("t", 0, 100), ("t", 1, 50)],
                                 "topic string, part int, end_offset bigint")
    assigned = spark.createDataFrame(
        [("g1", "t", 0, 90), ("g1", "t", 1, 50), ("g2", "t", 0, 10), ("g2", "t", 1, None)],
        "grp string, topic string, part int, committed bigint")
    got = rows(metrics.consumer_lag(ends, assigned), "grp", "part", "lag")
    assert got == srt([("g1", 0, 10), ("g1", 1, 0), ("g2", 0, 90), ("g2", 1, None)])


def test_last_per_step_and_latest(spark):
    s = spark.createDataFrame([("c", T0 + dt.timedelta(seconds=1), 1, 5.0),
                               ("c", T0 + dt.timedelta(seconds=3), 2, 6.0),
                               ("c", T0 + dt.timedelta(seconds=3), 3, 7.0),
                               ("c", T0 + dt.timedelta(seconds=6), 4, 8.0)],
                              "city string, ts timestamp, id int, v double")
    grid = rows(metrics.last_per_step(s, ["city"], "ts", "v", "5 seconds", tie="id"), "v")
    assert grid == [(7.0,), (8.0,)]
    last = metrics.latest(s, ["city"], "ts", "v", tie="id").first()
    assert last.latest_value == 8.0
    total = metrics.gauge_sum(s, ["city"], "ts", "v").first()[0]
    assert total == 8
