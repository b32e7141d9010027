"""Source and sink registries: a type name in a config maps to a reader or a
writer.  Adding a connector is one entry; unknown names raise ``KeyError``.

Sources: ``fn(spark, options, streaming) -> DataFrame``.
Sinks:   ``fn(df, options, trigger) -> StreamingQuery | None``.
Everything is ``format(...).options(...)``; Kafka and JDBC need their
connector jars on the cluster and are passed through untested here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.sources.tables import table_stream

# Fixed value: broker address used when a Kafka config names none.
DEFAULT_BROKERS = "localhost:9092"

SourceFn = Callable[[SparkSession, dict, bool], DataFrame]
SinkFn = Callable[[DataFrame, dict, dict], "StreamingQuery | None"]
SOURCES: dict[str, SourceFn] = {}
SINKS: dict[str, SinkFn] = {}


def _file_source(fmt: str) -> SourceFn:
    def read(spark: SparkSession, options: dict, streaming: bool) -> DataFrame:
        opts = dict(options)
        path = opts.pop("path")
        schema = opts.pop("schema", None)
        if streaming:
            if schema is None:  # file streams need a schema; take the batch one
                schema = spark.read.format(fmt).options(**opts).load(path).schema
            elif isinstance(schema, str):
                schema = StructType.fromDDL(schema)
            return table_stream(spark, path, schema, fmt, **opts)
        r = spark.read.format(fmt).options(**opts)
        return (r.schema(schema) if schema else r).load(path)
    return read


for _fmt in ("parquet", "json", "csv", "orc", "text"):
    SOURCES[_fmt] = _file_source(_fmt)


def broker_options(options: dict) -> dict:
    """Kafka options with the brokers under the connector's name, whether a
    config calls them that or ``bootstrap_servers`` (text or a list)."""
    opts = dict(options)
    named = opts.pop("bootstrap_servers", None)
    if named is not None and not isinstance(named, str):
        named = ",".join(named)
    return {"kafka.bootstrap.servers": named or DEFAULT_BROKERS, **opts}


def _kafka_source(spark: SparkSession, options: dict, streaming: bool) -> DataFrame:
    opts = {"startingOffsets": "earliest", **broker_options(options)}
    if "topic" in opts and not opts.keys() & {"subscribe", "subscribePattern", "assign"}:
        opts["subscribe"] = opts.pop("topic")
    r = spark.readStream if streaming else spark.read
    return r.format("kafka").options(**opts).load()


def _jdbc_source(spark: SparkSession, options: dict, streaming: bool) -> DataFrame:
    if streaming:
        raise ValueError("jdbc is a batch source")
    return spark.read.format("jdbc").options(**options).load()


def _rate_source(spark: SparkSession, options: dict, streaming: bool) -> DataFrame:
    if not streaming:
        raise ValueError("rate is a streaming source")
    return spark.readStream.format("rate").options(**options).load()


SOURCES["kafka"] = _kafka_source
SOURCES["jdbc"] = _jdbc_source
SOURCES["rate"] = _rate_source


def _start(df: DataFrame, fmt: str, options: dict, trigger: dict) -> StreamingQuery:
    opts = dict(options)
    mode = opts.pop("outputMode", "append")
    w = df.writeStream.format(fmt).options(**opts).outputMode(mode).trigger(**trigger)
    return w.start()


def _file_sink(fmt: str) -> SinkFn:
    def write(df: DataFrame, options: dict, trigger: dict):
        if df.isStreaming:
            return _start(df, fmt, options, trigger)
        opts = dict(options)
        path = opts.pop("path")
        mode = opts.pop("mode", "append")
        part = opts.pop("partitionBy", None)
        w = df.write.format(fmt).mode(mode).options(**opts)
        if part:
            w = w.partitionBy(*([part] if isinstance(part, str) else part))
        w.save(path)
        return None
    return write


for _fmt in ("parquet", "json", "csv", "orc"):
    SINKS[_fmt] = _file_sink(_fmt)


def _kafka_sink(df: DataFrame, options: dict, trigger: dict):
    opts = broker_options(options)
    if df.isStreaming:
        return _start(df, "kafka", opts, trigger)
    df.write.format("kafka").options(**opts).save()
    return None


def _console_sink(df: DataFrame, options: dict, trigger: dict):
    if df.isStreaming:
        return _start(df, "console", options, trigger)
    df.show(int(options.get("numRows", 20)), truncate=False)
    return None


def _noop_sink(df: DataFrame, options: dict, trigger: dict):
    if df.isStreaming:
        return _start(df, "noop", options, trigger)
    df.write.format("noop").mode("overwrite").save()
    return None


SINKS["kafka"] = _kafka_sink
SINKS["console"] = _console_sink
SINKS["noop"] = _noop_sink


def build_source(spark: SparkSession, spec: dict, streaming: bool) -> DataFrame:
    return SOURCES[spec["type"]](spark, spec.get("options") or {}, streaming)


def build_sink(spec: dict) -> SinkFn:
    return SINKS[spec["type"]]
