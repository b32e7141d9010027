"""Append-only log records in the Kafka source column layout, and the scans
over them: JSON topic decode, declared typed scan, bounded scan.  Values stay
binary (raw bytes) until a decoder reads them (JSON, frames, Avro).

Layout: key binary, value binary, topic string, partition int, offset bigint,
timestamp timestamp.  The same functions serve a Kafka stream
(``readStream.format("kafka")``) and a file-backed log (Parquet with these
columns), batch or streaming.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.codec import iso_parse, json_decode, json_encode

LOG_SCHEMA = ("key binary, value binary, topic string, partition int, "
              "offset bigint, timestamp timestamp")


def to_log(df: DataFrame, value: Column, topic: str, partition: Column | None = None,
           offset: Column | None = None, timestamp: Column | None = None,
           key: Column | None = None) -> DataFrame:
    """Rows as log records (no key unless given, as the producers send)."""
    return df.select(
        (key.cast("binary") if key is not None else F.lit(None).cast("binary")).alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (partition if partition is not None else F.lit(0)).cast("int").alias("partition"),
        (offset if offset is not None else F.lit(None)).cast("bigint").alias("offset"),
        (timestamp if timestamp is not None else F.current_timestamp()).cast("timestamp")
        .alias("timestamp"),
    )


def json_records(df: DataFrame, fields: list[str]) -> Column:
    """JSON bytes of the given columns (null fields left out)."""
    return json_encode(F.struct(*fields))


def json_topic_decode(log: DataFrame, schema: StructType | str,
                      mode: str = "PERMISSIVE", keep: tuple[str, ...] = ()) -> DataFrame:
    """Decode each value as UTF-8 JSON into typed columns.

    With PERMISSIVE the undecodable rows get null fields (route them through
    the contract check to learn why); FAILFAST stops the job instead.
    """
    rec = json_decode("value", schema, mode).alias("_rec")
    return log.select(*keep, rec).select(*keep, "_rec.*")


def declared_scan(log: DataFrame, ddl: str, time_col: str | None = None,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """A table with a declared DDL schema over a JSON topic; ``time_col``
    is read as ISO-8601 text into an instant (bad text -> null)."""
    if time_col is None:
        return json_topic_decode(log, ddl, keep=keep)
    schema = StructType.fromDDL(ddl)
    text_schema = StructType([
        StructField(f.name, StringType(), True) if f.name == time_col else f
        for f in schema.fields])
    out = json_topic_decode(log, text_schema, keep=keep)
    return out.withColumn(time_col, iso_parse(F.col(time_col)))


def bounded(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``order`` (a top-k, not a sample)."""
    return df.orderBy(*order).limit(n)
