"""Log relations derived from the given ``events`` table.

``rides``       one ride per event.
``deliveries``  the delivered log: every 7th ride is resent straight after the
                first copy; offsets are dense per log partition.
``feed``        arrival batches: a ride arrives on its event day, every 11th
                ride three days late.
``ride_json``   the rides as JSON records of the v1 ride contract, with the
                damage used by the contract checks.

Event times in the given tables are zone-less and mean UTC; they are turned
into instants here (``use_utc`` pins the session zone).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.codec import iso_format
from tidemark.operators.offsets import assign_offsets, end_offsets
from tidemark.session import use_utc
from tidemark.sources.tables import table

# The four pickup cities of the late-data producer.
CITIES = ["Columbus", "Cleveland", "Cincinnati", "Toledo"]

RESEND_EVERY = 7          # ride_id % 7 == 0 is delivered twice
LATE_EVERY = 11           # ride_id % 11 == 0 arrives late
LATE_BATCHES = 3          # ... by three arrival batches
BAD_FARE_EVERY = 13       # contract damage: fare sent as text
NO_STATUS_EVERY = 17      # contract damage: status left out
# Fixed value: the bad fare text of the contract demo record.
BAD_FARE_TEXT = "forty two dollars"

OFFSET_BLOCK_IDS = 1 << 16  # ride ids per offset block (see offsets.assign_offsets)
LOG_PARTS = 4
QUIET_AFTER = 10          # day of the month after which the last partition of ``arrivals`` is quiet
DAY_MICROS = 86_400_000_000


def _city(idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in CITIES]), idx + 1)


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return rides_from(table(spark, sf_dir, "events"))


def rides_from(ev: DataFrame) -> DataFrame:
    """The ride columns of an ``events`` DataFrame (batch or streaming)."""
    return ev.select(
        F.col("event_id").alias("ride_id"),
        "user_id",
        _city((F.col("user_id") % 4).cast("int")).alias("pickup_city"),
        F.col("value").alias("fare"),
        F.col("event_type").alias("status"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )


def _delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rides + resent copies, with their log partition."""
    r = rides(spark, sf_dir)
    copies = F.when(F.col("ride_id") % RESEND_EVERY == 0, F.array(F.lit(0), F.lit(1))) \
        .otherwise(F.array(F.lit(0)))
    return r.withColumn("copy", F.explode(copies)) \
        .withColumn("part", (F.col("user_id") % LOG_PARTS).cast("int"))


def _offset_block() -> Column:
    return F.expr(f"CAST(ride_id AS BIGINT) div {OFFSET_BLOCK_IDS}")


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rides + resent copies, with log partition ``part`` and offset ``off``."""
    return assign_offsets(_delivered(spark, sf_dir), "part", ["ride_id", "copy"], _offset_block(), "off")


def delivery_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(part, end_offset) of ``deliveries``, by counting."""
    return end_offsets(_delivered(spark, sf_dir), "part", _offset_block())


def arrival_day(ts: Column) -> Column:
    """Days since the epoch of an instant (UTC), by exact floor division."""
    us = F.unix_micros(ts)
    day = F.lit(DAY_MICROS)
    return ((us - F.pmod(us, day)) / day).cast("bigint")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_from(rides(spark, sf_dir))


def feed_from(r: DataFrame) -> DataFrame:
    late = F.when(F.col("ride_id") % LATE_EVERY == 0, F.lit(LATE_BATCHES)).otherwise(F.lit(0))
    return r.withColumn("batch", arrival_day(F.col("event_time")) + late)


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``feed`` as a log: partitions in order of arrival with dense offsets.  The last partition
    goes quiet: its rides after the ``QUIET_AFTER``th of the month go to the one before it."""
    p = (F.col("user_id") % LOG_PARTS).cast("int")
    quiet = (p == LOG_PARTS - 1) & (F.dayofmonth("event_time") > QUIET_AFTER)
    f = feed(spark, sf_dir).withColumn("part", F.when(quiet, LOG_PARTS - 2).otherwise(p))
    return assign_offsets(f, "part", ["batch", "ride_id"], F.col("batch"), "off")


def ride_records(r: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The v1 contract fields of each ride (ride_id as text, ISO event time),
    plus the ``keep`` columns passed through."""
    return r.select(
        F.col("ride_id").cast("string").alias("ride_id"),
        F.concat(F.lit("rider-"), F.col("user_id").cast("string")).alias("rider_name"),
        "pickup_city",
        _city(((F.col("user_id") + 1) % 4).cast("int")).alias("dropoff_city"),
        "fare",
        "status",
        iso_format(F.col("event_time")).alias("event_time"),
        *keep,
    )


def ride_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ride_id bigint, value string): damaged JSON records for contract checks."""
    return damaged_json(rides(spark, sf_dir))


def damaged_json(r: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(ride_id bigint, value string, keep...): v1 JSON text of each ride with
    the contract damage applied: every 13th ride sends its fare as text,
    every 17th leaves out its status."""
    rid = F.col("ride_id").cast("bigint")
    fare = F.when(rid % BAD_FARE_EVERY == 0, F.lit(BAD_FARE_TEXT).cast("variant")).otherwise(
        F.col("fare").cast("variant"))
    status = F.when(rid % NO_STATUS_EVERY == 0, F.lit(None).cast("string")).otherwise(
        F.col("status"))
    doc = F.struct("ride_id", "rider_name", "pickup_city", "dropoff_city",
                   fare.alias("fare"), status.alias("status"), "event_time")
    return ride_records(r, keep).select(rid.alias("ride_id"),
                                                F.to_json(doc).alias("value"), *keep)
