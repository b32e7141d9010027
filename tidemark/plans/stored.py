"""Queries over stored state: a key store, a log stored by offset, a schema registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import codec
from tidemark.operators import audit, contracts, delivery, schemas
from tidemark.session import fresh_dir
from tidemark.sources import relations as rel
from tidemark.sources.keystore import KeyStore
from tidemark.sources.offset_log import end_offsets, scan_from, store_log
from tidemark.sources.registry import Registry
from tidemark.sources.split_store import SplitStore
from tidemark.streaming import dedup, runner, state

#: Shares of the log that each run reads: it starts before the last one ended (replays).
RUNS = ((0.0, 0.2), (0.15, 0.4), (0.35, 0.6), (0.55, 0.8), (0.75, 1.0))
RESUME_AT = 0.9


def _stored(spark, sf_dir) -> str:
    d = rel.deliveries(spark, sf_dir).select("ride_id", "part", "off")
    return store_log(d, fresh_dir(spark, "offset-log"))


def dedup_key_store(spark, sf_dir):
    """Five runs over a stored log, each from offsets the one before had not committed.  Every run
    takes the first delivery of each ride that no earlier run took; the keys lie in buckets, which
    runs join as they are and merge now and then."""
    path, out = _stored(spark, sf_dir), fresh_dir(spark, "run-rows")
    ends = end_offsets(spark, path)
    store = KeyStore(spark, fresh_dir(spark, "key-store"), "bigint", buckets=16, fanout=2)
    share = lambda s: F.floor(F.col("end_offset") * F.lit(s)).cast("bigint")
    for n, (begin, end) in enumerate(RUNS, 1):
        rows = scan_from(spark, path, ends.select("part", share(begin).alias("committed")))
        upto = ends.select(F.col("part").alias("_p"), share(end).alias("upto"))
        rows = rows.join(upto, rows["part"].eqNullSafe(upto["_p"])).where("off < upto").select("ride_id", "part", "off")
        delivery.stored_run(rows, store, "ride_id", ["part", "off"], out, f"{n}")
    return spark.read.parquet(out).select("ride_id", "part", "off", F.col("run_id").cast("int").alias("run"))


def resume_stored_log(spark, sf_dir):
    """The stored log from 90 % of each partition: what was committed is skipped, not read."""
    path = _stored(spark, sf_dir)
    committed = end_offsets(spark, path).select("part", F.floor(F.col("end_offset") * RESUME_AT).cast("bigint").alias("committed"))
    return scan_from(spark, path, committed).select("ride_id", "part", "off")


def registry_usage(spark, sf_dir):
    """Framed records counted by the registered version they were written with, the registry stored:
    two versions of the rides, one refused, one repeated, and a second subject.  An id that is not
    registered stays, without a subject; a version no record uses has none."""
    registry = Registry(spark, fresh_dir(spark, "registry"))
    for subject, text in ((schemas.RIDE_SUBJECT, schemas.RIDE_V1), (schemas.RIDE_SUBJECT, schemas.RIDE_V2_BREAKING),
                          (schemas.RIDE_SUBJECT, schemas.RIDE_V2_SAFE), ("deliveries-value", schemas.RIDE_V2_BREAKING),
                          (schemas.RIDE_SUBJECT, schemas.RIDE_V1), ("deliveries-value", schemas.RIDE_V1)):
        registry.register(subject, text)
    r = rel.rides(spark, sf_dir)
    framed = r.select(codec.unframe(codec.frame((1 + F.col("ride_id") % 5).cast("bigint"), F.encode("pickup_city", "UTF-8"))).alias("u"))
    used = framed.groupBy(F.col("u.schema_id").alias("schema_id")).agg(F.count(F.lit(1)).alias("records"))
    return contracts.route_by_schema_id(used, registry.table()).select("schema_id", "subject", "version", "records")


def quarantine_replay(spark, sf_dir):
    """The damaged JSON records, split by the first contract in two batches; then a version in which
    the status may be missing takes what it can from the refused ones, twice: the second replay
    moves nothing.  Both tables are returned."""
    store = SplitStore(spark, fresh_dir(spark, "split-store"))
    first, later = (schemas.Contract.parse(t) for t in (schemas.RIDE_V1, schemas.RIDE_V2_STATUS))
    records = rel.ride_json(spark, sf_dir)
    for batch in (0, 1):
        store.ingest(f"{batch}", records.where(F.col("ride_id") % 2 == batch).select("value"), "value", first)
    for _ in range(2):
        store.replay("status may be missing", "value", later)
    nothing = F.lit(None).cast("string")
    good = store.accepted(later).select(F.lit("accepted").alias("side"), "ride_id", "fare", "status", nothing.alias("violations"))
    return good.unionByName(store.refused().select(
        F.lit("refused").alias("side"), F.get_json_object("value", "$.ride_id").alias("ride_id"), F.lit(None).cast("double").alias("fare"),
        nothing.alias("status"), F.array_join("violations", ",").alias("violations")))


#: Offsets of a block of the stored audit, and shares of each partition's blocks that are audited.
AUDIT_BLOCK, AUDIT_UPTO = 256, (0.25, 0.5, 1.0)


def audit_ranges(spark, sf_dir):
    """Duplicate audits of growing ranges of the log, merged from stored sketches of its blocks: the
    exact number of records, and whether the distinct rides lie within the sketch's error of those
    that the log itself holds."""
    log = rel.deliveries(spark, sf_dir).select("ride_id", "part", "off", F.floor(F.col("off") / AUDIT_BLOCK).alias("block"))
    path = fresh_dir(spark, "audit-sketches")
    audit.block_sketches(log, "ride_id", "part", "off", AUDIT_BLOCK).write.parquet(path)
    kept = spark.read.parquet(path)
    last = kept.groupBy("part").agg(F.max("block").alias("last")).withColumnRenamed("part", "_p")
    upto = F.explode(F.filter(F.array(*[F.lit(s) for s in AUDIT_UPTO]), lambda s: F.col("block") <= F.floor(F.col("last") * s))).alias("share")

    def ranged(df: DataFrame) -> DataFrame:
        return df.join(last, df["part"].eqNullSafe(last["_p"])).drop("_p").select(*df.columns, upto)

    merged = audit.merged_audit(ranged(kept), ("share",))
    exact = ranged(log).groupBy("share").agg(F.count_distinct("ride_id").alias("exact")).withColumnRenamed("share", "_s")
    told = merged.join(exact, F.col("share") == F.col("_s"))
    return told.select("share", "processed", F.col("exact").alias("unique_rides"),
                       (F.abs(F.col("unique_rides") - F.col("exact")) <= F.col("most_error")).alias("within_error"))


def stream_state_keys(spark, sf_dir):
    """What the state of a stream dedup holds after its run, read from the checkpoint: each key, and
    whether the figures of its state partition count it."""
    d = rel.deliveries(spark, sf_dir).select("ride_id", "event_time")
    source = runner.stage(d, "state-source")
    run = runner.run_available_now(dedup.dedup(runner.file_stream(spark, source, d.schema), ["ride_id"]), "state")
    figures = state.state_figures(spark, run.checkpoint)
    keys = state.state(spark, run.checkpoint).select(F.col("key.ride_id").alias("ride_id"), "partition_id")
    return keys.join(figures, "partition_id").select("ride_id", (F.col("keys") > 0).alias("counted"))


QUERIES = {f.__name__: f for f in (dedup_key_store, resume_stored_log, registry_usage, quarantine_replay, audit_ranges,
                                  stream_state_keys)}
