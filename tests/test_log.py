"""The log API over a Parquet log in the Kafka source column layout."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators import contracts, delivery, schemas
from tidemark.session import fresh_dir
from tidemark.sources import log as logs
from tidemark.sources import relations as rel
from tidemark.sources.relations import ride_records

V1 = schemas.Contract.parse(schemas.RIDE_V1)


def _kafka_log(spark):
    d = rel.deliveries(spark, SF_SMALL)
    rec = ride_records(d, keep=("part", "off"))
    lg = logs.to_log(rec, logs.json_records(rec, [f.name for f in V1.fields]), "rides_chaos",
                     partition=F.col("part"), offset=F.col("off"),
                     timestamp=F.lit("2026-09-23 12:00:00").cast("timestamp"))
    path = fresh_dir(spark, "kafka-layout-log")
    lg.write.parquet(path)
    return spark.read.parquet(path)


def test_layout(spark):
    lg = _kafka_log(spark)
    assert [f.name for f in lg.schema.fields] == ["key", "value", "topic", "partition",
                                                  "offset", "timestamp"]
    assert lg.schema["value"].dataType.simpleString() == "binary"


def test_resume_decode_validate_dedup(spark):
    lg = _kafka_log(spark)
    committed = lg.select("partition").distinct().withColumn("committed", F.lit(100).cast("bigint"))
    resumed = delivery.resume_from_offsets(lg, committed, "partition", "offset")
    assert resumed.where("offset < 100").count() == 0
    assert resumed.count() == lg.count() - 4 * 100
    decoded = logs.json_topic_decode(resumed, V1.spark_schema(), keep=("partition", "offset"))
    assert decoded.where(F.col("ride_id").isNull()).count() == 0
    v = contracts.validate(resumed.select("partition", "offset", "value"), "value", V1)
    ok = contracts.accepted(v, V1, keep=("partition", "offset"))
    assert ok.count() == resumed.count()
    first = delivery.keep_first(ok, "ride_id", ["partition", "offset"])
    assert first.count() == first.select("ride_id").distinct().count()
    assert first.count() == decoded.select("ride_id").distinct().count()
