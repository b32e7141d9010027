"""Queries over times: watermarks by log partition, rates over a sliding range, grids that hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import partition_watermark as pw
from tidemark.operators import ranges
from tidemark.session import with_rocksdb
from tidemark.sources import relations as rel
from tidemark.streaming import outcomes, runner

DELAY_S = 5
OUTCOME_DELAY, OUTCOME_HORIZON_S = "4 days", 12 * 86_400
IDLE_BATCHES = 3


def _zoneless(df: DataFrame) -> DataFrame:
    from tidemark.plans.queries import zoneless
    return zoneless(df)


def _arrivals(spark, sf_dir) -> DataFrame:
    return rel.arrivals(spark, sf_dir).select("ride_id", "pickup_city", "event_time", "batch", "part", "off")


def _trace(log: DataFrame) -> DataFrame:
    return pw.watermark_by_batch(log, "event_time", "part", "batch", DELAY_S, IDLE_BATCHES)


def watermark_by_partition(spark, sf_dir):
    """The log's watermark after each arrival day: least over partitions that aren't idle, and
    without the idle rule."""
    return _zoneless(_trace(_arrivals(spark, sf_dir)))


def late_by_partition(spark, sf_dir):
    """Per log partition: its records, those that were late under the log's watermark, and those
    behind their own partition's watermark when they were read."""
    log = _arrivals(spark, sf_dir)
    late = pw.late_by_watermark(log, _trace(log), "event_time", "batch", "10 seconds")
    own = pw.partition_watermark(late, "event_time", "part", "off", DELAY_S)
    return own.groupBy("part").agg(
        F.count(F.lit(1)).alias("records"), F.count_if("is_late").alias("late_records"),
        F.count_if(F.col("event_time") < F.col("partition_watermark")).alias("behind_records"))


def closed_by_partition_watermark(spark, sf_dir):
    """10 s windows per city that the log's watermark has closed; ``held``: an idle partition would
    have kept them open."""
    log = _arrivals(spark, sf_dir)
    trace = _trace(log)
    rows = pw.late_by_watermark(log, trace, "event_time", "batch", "10 seconds")
    return _zoneless(pw.closed_counts(rows, trace, ["pickup_city"]))


def _topic_rate(seconds: int, step: int):
    def run(spark, sf_dir):
        d = rel.deliveries(spark, sf_dir).select(F.col("status").alias("topic"), "part", "event_time", "off")
        r = ranges.rate_at_steps(d, ["topic", "part"], "event_time", "off", seconds, step)
        return _zoneless(r.groupBy("topic", F.col("event_time").alias("ts")).agg(F.round(F.sum("rate"), 9).alias("rate")))

    return run


def held_fares(spark, sf_dir):
    """Fares as a gauge per city at every minute of the table's range; a value holds for 5 minutes."""
    r = rel.rides(spark, sf_dir).select(F.col("pickup_city").alias("city"), F.col("event_time").alias("ts"), "ride_id", "fare")
    return _zoneless(ranges.held_grid(r, ["city"], "ts", "fare", 60, 300, tie="ride_id"))


def stream_dedup_outcomes(spark, sf_dir):
    """The delivered log by user, as it arrives in periods of ten days: what a bounded stream dedup
    accepts, what it knows already, and what comes too late to tell.  Every 11th ride arrives a
    period late, a resent copy a period after the first."""
    d = rel.deliveries(with_rocksdb(spark), sf_dir)
    late = F.when(F.col("ride_id") % rel.LATE_EVERY == 0, 1).otherwise(0)
    day = rel.arrival_day(F.col("event_time"))
    d = d.select("ride_id", "user_id", "event_time", (F.floor(day / 10) + late + F.col("copy")).cast("bigint").alias("period"))
    run = runner.run_in_arrivals(
        d, "period", lambda s: outcomes.dedup_outcomes(s, ["user_id"], "event_time", OUTCOME_DELAY, OUTCOME_HORIZON_S), "outcomes")
    out = spark.read.schema(run.output.schema).parquet(run.sink_path)  # in the given session
    return out.groupBy("ride_id", "period", "outcome").agg(F.sum("copies").alias("copies"))


QUERIES = {f.__name__: f for f in (watermark_by_partition, late_by_partition, closed_by_partition_watermark, held_fares,
                                  stream_dedup_outcomes)}
# sum(rate(offset[range])) by topic, at steps: the dashboard's minute, and an hour for sparser logs
QUERIES["topic_rate_1m"] = _topic_rate(60, 15)
QUERIES["topic_rate_1h"] = _topic_rate(3600, 900)
