"""Named queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the given tables (through the relations in
``tidemark.sources.relations``) over their whole extent.  Output timestamps
are zone-less (``timestamp_ntz``) like the tables they came from.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tidemark.functions import codec
from tidemark.operators import avro, contracts, delivery, eventtime, metrics, schemas
from tidemark.plans import ingest, stored, timing
from tidemark.session import fresh_dir
from tidemark.sources import log as logs
from tidemark.sources import relations as rel
from tidemark.sources.tables import table
from tidemark.streaming import contracts as scontracts
from tidemark.streaming import dedup as sdedup
from tidemark.streaming import progress as sprogress
from tidemark.streaming import runner, windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the log scenarios (see FIXTURES.md §3).
WATERMARK_DELAY_S = 5
# Shares of each partition's end offset, so that they grow with the log.
FIRST_RUN_PROCESSED = 0.5    # run 1 processed offsets below this ...
FIRST_RUN_COMMITTED = 0.45   # ... but committed only up to here, then crashed
RESUME_COMMITTED = 0.5       # committed offset every partition resumes from
BOUNDED_ROWS = 5


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


def zoneless(df: DataFrame) -> DataFrame:
    """Cast instant columns back to timestamp_ntz for output."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


# --- scans, bounded scan, ISO text -------------------------------------------

@query("raw_scan")
def raw_scan(spark, sf_dir):
    r = rel.rides(spark, sf_dir)
    return zoneless(r.select("ride_id", "pickup_city", "fare", "event_time"))


@query("bounded_scan")
def bounded_scan(spark, sf_dir):
    """The first N rides by id (a bounded source made deterministic)."""
    r = rel.rides(spark, sf_dir)
    return logs.bounded(r, ["ride_id"], BOUNDED_ROWS).select(
        F.col("pickup_city").alias("city"), "fare")


@query("iso_format")
def iso_format(spark, sf_dir):
    r = rel.rides(spark, sf_dir)
    return r.select("ride_id",
                    codec.iso_format("event_time").alias("event_time_text"),
                    codec.iso_format_offset("event_time").alias("event_time_offset_text"))


@query("iso_parse")
def iso_parse(spark, sf_dir):
    """Parse both ISO spellings back to instants (ms text loses the µs)."""
    r = rel.rides(spark, sf_dir)
    return zoneless(r.select(
        "ride_id",
        codec.iso_parse(codec.iso_format("event_time")).alias("parsed_ms"),
        codec.iso_parse(codec.iso_format_offset("event_time")).alias("parsed_us")))


# --- delivery correctness ----------------------------------------------------

def _deliveries(spark, sf_dir) -> DataFrame:
    return rel.deliveries(spark, sf_dir).select(
        "ride_id", "pickup_city", "fare", "status", "event_time", "part", "off")


@query("duplicate_audit")
def duplicate_audit(spark, sf_dir):
    return delivery.duplicate_audit(_deliveries(spark, sf_dir), "ride_id")


@query("duplicate_flag")
def duplicate_flag(spark, sf_dir):
    d = _deliveries(spark, sf_dir).select("ride_id", "part", "off")
    return delivery.flag_duplicates(d, "ride_id", ["part", "off"])


@query("dedup_keep_first")
def dedup_keep_first(spark, sf_dir):
    d = _deliveries(spark, sf_dir)
    return zoneless(delivery.keep_first(d, "ride_id", ["part", "off"]))


LINEITEM_KEY = ["l_orderkey", "l_linenumber"]


@query("dedup_keep_first_lineitem")
def dedup_keep_first_lineitem(spark, sf_dir):
    """Multi-column key whose rows differ: the total order is all columns."""
    li = table(spark, sf_dir, "lineitem")
    order = [c for c in li.columns if c not in LINEITEM_KEY]
    return delivery.keep_first(li, LINEITEM_KEY, order)


def _share(share: float):
    return F.floor(F.col("end_offset") * share).cast("bigint")


def _crashed_log(spark, sf_dir) -> DataFrame:
    """The log with, per row, where run 1 stopped and what it had committed."""
    d = _deliveries(spark, sf_dir).select("ride_id", "part", "off")
    e = rel.delivery_ends(spark, sf_dir).select(F.col("part").alias("_p"), _share(FIRST_RUN_PROCESSED).alias("processed"),
                        _share(FIRST_RUN_COMMITTED).alias("committed"))
    return d.join(e, d["part"].eqNullSafe(e["_p"])).drop("_p")


def _incremental_inputs(spark, sf_dir):
    """The log with a row for each run that reads a record: 1 (keys seen) and 2 (its input)."""
    runs = F.array(F.when(F.col("off") < F.col("processed"), F.lit(1)),
                   F.when(F.col("off") >= F.col("committed"), F.lit(2)))
    d = _crashed_log(spark, sf_dir).select("ride_id", "part", "off",
                                           F.explode(F.array_compact(runs)).alias("run"))
    return d


@query("dedup_incremental")
def dedup_incremental(spark, sf_dir):
    d = _incremental_inputs(spark, sf_dir)
    return delivery.dedup_flagged(d, F.col("run") == 1, "ride_id", ["part", "off"]) \
        .select("ride_id", "part", "off")


@query("run_summary")
def run_summary(spark, sf_dir):
    d = _incremental_inputs(spark, sf_dir)
    return delivery.summary_flagged(d, F.col("run") == 1, "ride_id", ["part", "off"])


@query("dedup_saved_state")
def dedup_saved_state(spark, sf_dir):
    """Two runs with their state saved between them: run 1 takes the log up to
    where it crashed and saves the keys it took; run 2 starts again from the
    committed offsets with the saved keys.  What run 2 took is read back."""
    d = _crashed_log(spark, sf_dir)
    cols = ["ride_id", "part", "off"]
    out, seen = fresh_dir(spark, "dedup-rows"), fresh_dir(spark, "dedup-seen")
    delivery.incremental_run(d.where("off < processed").select(cols), seen, "ride_id",
                             ["part", "off"], out, "run-1", key_type="bigint")
    return delivery.incremental_run(d.where("off >= committed").select(cols), seen, "ride_id",
                                    ["part", "off"], out, "run-2", key_type="bigint")


@query("crash_replay")
def crash_replay(spark, sf_dir):
    d = _crashed_log(spark, sf_dir)
    return delivery.replay_audit(d, "ride_id", "off", F.col("processed"), F.col("committed"))


@query("resume_from_offsets")
def resume_from_offsets(spark, sf_dir):
    d = _deliveries(spark, sf_dir).select("ride_id", "part", "off")
    committed = rel.delivery_ends(spark, sf_dir).select("part", _share(RESUME_COMMITTED).alias("committed"))
    return delivery.resume_from_offsets(d, committed, "part", "off")


# --- event time (batch) ------------------------------------------------------

def _tumble(width: str, closed: bool) -> Query:
    def run(spark, sf_dir):
        r = rel.rides(spark, sf_dir)
        if closed:
            out = eventtime.tumble_count_closed(r, "event_time", ["pickup_city"], width,
                                                WATERMARK_DELAY_S)
        else:
            out = eventtime.tumble_count(r, "event_time", ["pickup_city"], width)
        return zoneless(out)
    return run


QUERIES["tumble_count"] = _tumble("10 seconds", False)
QUERIES["tumble_count_1h"] = _tumble("1 hour", False)
QUERIES["tumble_count_closed"] = _tumble("10 seconds", True)
QUERIES["tumble_count_closed_1h"] = _tumble("1 hour", True)


@query("watermark_trace")
def watermark_trace(spark, sf_dir):
    f = rel.feed(spark, sf_dir)
    return zoneless(eventtime.watermark_trace(f, "event_time", "batch", WATERMARK_DELAY_S))


@query("late_classify")
def late_classify(spark, sf_dir):
    f = rel.feed(spark, sf_dir)
    c = eventtime.late_classify(f, "event_time", "batch", "10 seconds", WATERMARK_DELAY_S)
    return zoneless(c.select("ride_id", "batch", "window_start", "window_end", "is_late"))


def _late_drops(width: str, lag: int = 2) -> Query:
    def run(spark, sf_dir):
        f = rel.feed(spark, sf_dir)
        return eventtime.late_drop_count(f, "event_time", "batch", width, WATERMARK_DELAY_S,
                                         lag=lag)
    return run


QUERIES["late_drop_count"] = _late_drops("10 seconds")
QUERIES["late_drop_count_1h"] = _late_drops("1 hour")
QUERIES["late_drop_count_1d"] = _late_drops("1 day")
# the ideal rule: a batch is filtered with everything that arrived before it
QUERIES["late_drop_count_ideal"] = _late_drops("10 seconds", lag=1)


# --- JSON log codec ------------------------------------------------------------


V1 = schemas.Contract.parse(schemas.RIDE_V1)
V1_FIELDS = [f.name for f in V1.fields]


def _ride_log(spark, sf_dir) -> DataFrame:
    r = rel.rides(spark, sf_dir)
    rec = rel.ride_records(r).withColumn("_part", (F.col("ride_id") % 4).cast("int"))
    return logs.to_log(rec, logs.json_records(rec, V1_FIELDS), "rides",
                       partition=F.col("_part"), timestamp=F.lit(None))


@query("json_topic_encode")
def json_topic_encode(spark, sf_dir):
    lg = _ride_log(spark, sf_dir)
    return lg.select(F.get_json_object(F.decode("value", "UTF-8"), "$.ride_id")
                     .cast("bigint").alias("ride_id"),
                     F.decode("value", "UTF-8").alias("value_text"),
                     F.octet_length("value").cast("bigint").alias("value_bytes"))


@query("json_topic_decode")
def json_topic_decode(spark, sf_dir):
    """Encode the rides as JSON records, then decode them with the v1 schema."""
    return logs.json_topic_decode(_ride_log(spark, sf_dir), V1.spark_schema())


@query("raw_scan_declared")
def raw_scan_declared(spark, sf_dir):
    """Declared typed scan over the JSON log: ISO text -> instant."""
    lg = _ride_log(spark, sf_dir)
    t = logs.declared_scan(lg, "ride_id string, pickup_city string, fare double, "
                               "event_time timestamp", time_col="event_time")
    return zoneless(t)


# --- contracts -----------------------------------------------------------------

def _validated(spark, sf_dir) -> DataFrame:
    return contracts.validate(rel.ride_json(spark, sf_dir), "value", V1)


@query("contract_validate")
def contract_validate(spark, sf_dir):
    v = _validated(spark, sf_dir)
    return v.select(F.try_variant_get("_record", "$.ride_id", "string").alias("ride_id"),
                    F.array_join("violations", ",").alias("violations"))


@query("contract_accept")
def contract_accept(spark, sf_dir):
    return contracts.accepted(_validated(spark, sf_dir), V1)


@query("contract_quarantine")
def contract_quarantine(spark, sf_dir):
    q = contracts.quarantined(_validated(spark, sf_dir))
    return q.select(F.col("ride_id").cast("string").alias("ride_id"),
                    F.array_join("violations", ",").alias("violations"))


@query("contract_summary")
def contract_summary(spark, sf_dir):
    return contracts.summary(_validated(spark, sf_dir))


@query("evolve_union")
def evolve_union(spark, sf_dir):
    """Even rides written with v1, odd rides with v2_safe (driver_rating =
    fare / 100); merged into one v2_safe table."""
    v2 = schemas.Contract.parse(schemas.RIDE_V2_SAFE)
    r = rel.rides(spark, sf_dir)
    rec = rel.ride_records(r).withColumn("_id", F.col("ride_id").cast("bigint"))
    old = rec.where(F.col("_id") % 2 == 0).drop("_id")
    new = rec.where(F.col("_id") % 2 == 1).withColumn("driver_rating", F.col("fare") / 100) \
        .drop("_id")
    merged = contracts.evolve_union([old, new], v2)
    return merged.select(F.col("ride_id").cast("bigint").alias("ride_id"), "pickup_city",
                         "fare", "driver_rating")


@query("schema_compat")
def schema_compat(spark, sf_dir):
    """Which contract versions can read the records in the log?  The writer
    schema is observed from every accepted record (a merged-schema aggregate
    over the whole log); each candidate is checked against it."""
    ok = _validated(spark, sf_dir).where(F.size("violations") == 0)
    candidates = {"v1": schemas.RIDE_V1, "v2_safe": schemas.RIDE_V2_SAFE,
                  "v2_breaking": schemas.RIDE_V2_BREAKING, "v2_removed": schemas.RIDE_V2_REMOVED}
    seen = contracts.compat_with_observed(ok, "_record", candidates).select(
        F.lit(None).cast("string").alias("subject"), "candidate",
        F.when(F.col("compatible"), "compatible").otherwise("incompatible").alias("status"),
        F.array_join("problems", ",").alias("problems"))
    # the same candidates against the latest version registered for a subject
    rows, _ = schemas.register([], schemas.RIDE_SUBJECT, schemas.RIDE_V1)
    told = [(subject, name, *schemas.check_registered(rows, subject, text))
            for subject in (schemas.RIDE_SUBJECT, "rides_new-value") for name, text in candidates.items()]
    return seen.unionByName(spark.createDataFrame(
        [(s, n, status, ",".join(p)) for s, n, status, p in told],
        "subject string, candidate string, status string, problems string"))


# --- frames --------------------------------------------------------------------

def _frames(spark, sf_dir, versions: int) -> DataFrame:
    r = rel.rides(spark, sf_dir)
    sid = (1 + F.col("ride_id") % versions).cast("bigint")
    return r.select("ride_id", codec.frame(sid, F.encode("pickup_city", "UTF-8")).alias("value"))


@query("frame_split")
def frame_split(spark, sf_dir):
    f = _frames(spark, sf_dir, 2).select("ride_id", "value", codec.unframe("value").alias("u"))
    return f.select("ride_id", "u.magic", "u.schema_id",
                    F.octet_length("u.body").cast("bigint").alias("body_len"),
                    codec.encoded_length("value").cast("bigint").alias("frame_len"),
                    F.decode("u.body", "UTF-8").alias("body_text"), "u.problem")


def ride_registry_rows() -> list[tuple]:
    """Two registered versions of the ride subject (ids 1 and 2)."""
    rows, _ = schemas.register([], schemas.RIDE_SUBJECT, schemas.RIDE_V1)
    rows, _ = schemas.register(rows, schemas.RIDE_SUBJECT, schemas.RIDE_V2_SAFE)
    return rows


def registry_of_rides(spark) -> DataFrame:
    return schemas.registry_frame(spark, ride_registry_rows())


@query("frame_route")
def frame_route(spark, sf_dir):
    """Route framed records to their registered contract by schema id; an
    unknown id surfaces as a row with null subject and version."""
    f = _frames(spark, sf_dir, 3).select("ride_id", codec.unframe("value").alias("u"))
    reg = registry_of_rides(spark).select("schema_id", "subject", "version")
    routed = contracts.route_by_schema_id(
        f.select("ride_id", F.col("u.schema_id").alias("schema_id")), reg)
    return routed.select("ride_id", "schema_id", "subject", "version")


@query("schema_latest")
def schema_latest(spark, sf_dir):
    """Latest registered version per subject, with how many framed records in
    the log were written with it."""
    f = _frames(spark, sf_dir, 2).select(codec.unframe("value").alias("u"))
    used = f.groupBy(F.col("u.schema_id").alias("schema_id")).agg(
        F.count(F.lit(1)).alias("records"))
    lat = schemas.latest(registry_of_rides(spark))
    return lat.join(used, "schema_id", "left").select(
        "subject", "version", "schema_id", F.coalesce("records", F.lit(0)).alias("records"))


# --- streaming -------------------------------------------------------------------


def _events_schema(spark, sf_dir):
    return table(spark, sf_dir, "events").schema


def _ride_stream(spark, sf_dir, max_files=None) -> DataFrame:
    rel.rides(spark, sf_dir)  # pins the session zone
    ev = runner.events_stream(spark, sf_dir, _events_schema(spark, sf_dir), max_files)
    return rel.rides_from(ev)


@query("stream_tumble_count")
def stream_tumble_count(spark, sf_dir):
    """10 s windows per status under a 5 s watermark, append mode."""
    s = windows.with_event_time(_ride_stream(spark, sf_dir), "event_time", WATERMARK_DELAY_S)
    run = runner.run_available_now(
        windows.tumble_count(s, "event_time", ["status"], "10 seconds"), "tumble")
    return zoneless(run.output)


def _late_replay(spark, sf_dir):
    """The arrival batches of ``feed`` through a watermarked count."""
    f = rel.feed(spark, sf_dir).select("ride_id", "pickup_city", "event_time", "batch")
    return windows.late_replay(f, "event_time", ["pickup_city"], "batch", "10 seconds",
                               WATERMARK_DELAY_S)


@query("stream_late_replay")
def stream_late_replay(spark, sf_dir):
    """Arrival batches replayed one per trigger; late rows are dropped."""
    return zoneless(_late_replay(spark, sf_dir).output)


@query("stream_progress")
def stream_progress(spark, sf_dir):
    """Per micro-batch that had input: its rows and the watermark it ran under."""
    p = sprogress.progress_rows(spark, _late_replay(spark, sf_dir).progress)
    return p.where("num_input_rows > 0").select("batch_id", "num_input_rows", "watermark")


@query("watermark_policy")
def watermark_policy(spark, sf_dir):
    """Two sources into one count: every ride (A), and a second feed that
    carries only the first day of the month and then goes quiet (B).  The
    min policy holds windows back at B's watermark; max lets them close."""
    def sources(session):
        a = _ride_stream(session, sf_dir)
        return [a, _ride_stream(session, sf_dir).where(F.dayofmonth("event_time") == 1)]

    out = None
    for policy in ("min", "max"):
        run = windows.union_count(sources, spark, "event_time", ["pickup_city"], "10 seconds",
                                  WATERMARK_DELAY_S, policy)
        rows = spark.read.schema(run.output.schema).parquet(run.sink_path)
        part = rows.select(F.lit(policy).alias("policy"), "*")
        out = part if out is None else out.unionByName(part)
    return zoneless(out)


def _delivery_stream(spark, sf_dir, label):
    """The delivered log replayed in arrival order, one week per trigger."""
    d = _deliveries(spark, sf_dir).select("ride_id", "event_time", "part", "off")
    d = d.withColumn("week", F.floor(rel.arrival_day(F.col("event_time")) / 7).cast("bigint"))
    replay = windows.replay_batches(d, "week", label)
    return runner.file_stream(spark, replay.path, d.schema,
                              max_files=replay.files_per_trigger)


@query("stream_dedup")
def stream_dedup(spark, sf_dir):
    s = _delivery_stream(spark, sf_dir, "dedup")
    return runner.run_available_now(sdedup.dedup(s, ["ride_id"]), "dedup").output.select("ride_id")


@query("stream_dedup_bounded")
def stream_dedup_bounded(spark, sf_dir):
    s = _delivery_stream(spark, sf_dir, "dedup-bounded")
    s = sdedup.dedup_bounded(s, ["ride_id"], "event_time", "1 hour")
    return runner.run_available_now(s, "dedup-bounded").output.select("ride_id")


# --- monitoring metrics ----------------------------------------------------------


CHAOS_TOPIC = "rides_chaos"
# Consumer groups and the share of each partition's log they have committed.
GROUP_COMMITS = {"naive-consumer-group": 0.9, "idempotent-consumer-group": 0.75}
NEW_IN = ("idempotent-consumer-group", 3)   # assigned to the group, nothing committed yet
GRID_STEP = "5 seconds"
GRID_RANGE_S = 15 * 86_400


def _end_offsets(spark, sf_dir) -> DataFrame:
    return rel.delivery_ends(spark, sf_dir).select(F.lit(CHAOS_TOPIC).alias("topic"), "part",
                                                   "end_offset")


def _groups():
    """A row per consumer group: its name and the share of the log it has committed."""
    return F.explode(F.array(*[F.struct(F.lit(g).alias("grp"), F.lit(share).alias("share"))
                               for g, share in GROUP_COMMITS.items()])).alias("g")


@query("consumer_lag")
def consumer_lag(spark, sf_dir):
    end = _end_offsets(spark, sf_dir)
    # a group that has not yet committed in its last partition: no commit, no lag
    fresh = (F.col("g.grp") == NEW_IN[0]) & (F.col("part") == NEW_IN[1])
    assigned = end.select("topic", "part", "end_offset", _groups()).select(
        "g.grp", "topic", "part",
        F.when(~fresh, F.floor(F.col("end_offset") * F.col("g.share")).cast("bigint")).alias("committed"))
    return metrics.consumer_lag(end, assigned)


def _offset_samples(spark, sf_dir) -> DataFrame:
    """Per (topic = status, part) the log offset sampled hourly."""
    d = _deliveries(spark, sf_dir).select(F.col("status").alias("topic"), "part",
                                          "event_time", "off")
    return metrics.last_per_step(d, ["topic", "part"], "event_time", "off", "1 hour",
                                 out="value")


@query("topic_rate")
def topic_rate(spark, sf_dir):
    """sum(rate(offset)) by topic, one rate per day range."""
    s = _offset_samples(spark, sf_dir).withColumn("day", F.to_date("event_time"))
    r = metrics.counter_rate(s, ["topic", "part"], "event_time", "value", "day")
    return r.groupBy("topic", "day").agg(F.round(F.sum("rate"), 9).alias("rate"))


@query("offset_progress")
def offset_progress(spark, sf_dir):
    """Committed offset of every consumer group over time, one sample per hour:
    a group has committed its share of what the log then held."""
    d = _deliveries(spark, sf_dir)
    p = metrics.last_per_step(d, ["part"], "event_time", "off", "1 hour", out="newest")
    g = p.select("part", "event_time", "newest", _groups())
    return zoneless(g.select(
        "g.grp", F.lit(CHAOS_TOPIC).alias("topic"), "part", F.col("event_time").alias("ts"),
        F.floor((F.col("newest") + 1) * F.col("g.share")).cast("bigint").alias("committed_offset")))


@query("gauge_latest")
def gauge_latest(spark, sf_dir):
    r = rel.rides(spark, sf_dir).select(F.col("pickup_city").alias("city"), "event_time",
                                        "ride_id", "fare")
    return zoneless(metrics.latest(r, ["city"], "event_time", "fare", tie="ride_id"))


@query("partition_total")
def partition_total(spark, sf_dir):
    """sum over topics of the latest partition-count gauge (one per day)."""
    d = _deliveries(spark, sf_dir)
    g = d.groupBy(F.col("status").alias("topic"), F.to_date("event_time").alias("day")) \
        .agg(F.count_distinct("part").alias("partitions"))
    return metrics.gauge_sum(g, ["topic"], "day", "partitions", out="partition_total")


@query("scrape_grid")
def scrape_grid(spark, sf_dir):
    """Fares as a gauge per city on a 5 s grid, last 15 days of data."""
    r = rel.rides(spark, sf_dir).select(F.col("pickup_city").alias("city"), "event_time",
                                        "ride_id", "fare")
    g = metrics.last_per_step(metrics.in_last(r, "event_time", GRID_RANGE_S), ["city"],
                              "event_time", "fare", GRID_STEP, tie="ride_id", out="value")
    return zoneless(g.select("city", F.col("event_time").alias("ts"), "value"))


# --- config-driven ingest --------------------------------------------------------


@query("configured_ingest")
def configured_ingest(spark, sf_dir):
    """A config moves events -> rides into a Parquet table as a stream; the
    table is read back."""
    rel.rides(spark, sf_dir)  # pins the session zone
    out = fresh_dir(spark, "ingest-out")
    config = {
        "pipeline_name": "rides_stream",
        "mode": "stream",
        "trigger": "available_now",
        "source": {"type": "parquet",
                   "options": {"path": f"{sf_dir.rstrip('/')}/events.parquet"}},
        "transforms": [{"type": "rides"},
                       {"type": "select",
                        "columns": ["ride_id", "pickup_city", "fare", "event_time"]}],
        "sink": {"type": "parquet",
                 "options": {"path": out,
                             "checkpointLocation": fresh_dir(spark, "ingest-ckpt")}},
    }
    ingest.run(spark, config)
    return zoneless(spark.read.parquet(out))


# --- flagship: log -> contract split -> dedup -> closed tumbling count -------------

@query("flagship")
def flagship(spark, sf_dir):
    """The delivered log as JSON records (with resends and contract damage):
    quarantine the records that break the v1 contract, keep the first
    delivery of every ride, and count rides per city in closed 10 s windows
    under a 5 s watermark declared on the source (all delivered records)."""
    d = rel.deliveries(spark, sf_dir)
    wm = eventtime.final_watermark(rel.rides(spark, sf_dir), "event_time", WATERMARK_DELAY_S)
    lg = rel.damaged_json(d, keep=("part", "off"))
    ok = contracts.accepted(contracts.validate(lg, "value", V1), V1, keep=("part", "off"))
    first = delivery.keep_first(ok, "ride_id", ["part", "off"])
    timed = first.withColumn("event_time", codec.iso_parse("event_time"))
    counts = eventtime.tumble_count_closed(timed, "event_time", ["pickup_city"], "10 seconds",
                                           WATERMARK_DELAY_S, watermark=wm)
    return zoneless(counts)


# --- Avro bodies -----------------------------------------------------------------


@query("avro_decode")
def avro_decode(spark, sf_dir):
    """Even rides written with v1 (id 1), odd rides with v2_safe (id 2,
    driver_rating = fare / 100), as framed Avro; decoded in one pass to the
    v2_safe reader contract (v1 rows take the null default)."""
    v2 = schemas.Contract.parse(schemas.RIDE_V2_SAFE)
    r = rel.rides(spark, sf_dir)
    rec = rel.ride_records(r).withColumn("_id", F.col("ride_id").cast("bigint"))
    old = avro.encode_bodies(rec.where(F.col("_id") % 2 == 0), V1, keep=("_id",)) \
        .withColumn("schema_id", F.lit(1).cast("bigint"))
    new = avro.encode_bodies(
        rec.where(F.col("_id") % 2 == 1).withColumn("driver_rating", F.col("fare") / 100), v2,
        keep=("_id",)).withColumn("schema_id", F.lit(2).cast("bigint"))
    framed = old.unionByName(new).select(codec.frame("schema_id", "body").alias("value"))
    split = framed.select(codec.unframe("value").alias("u")).select("u.schema_id", "u.body")
    writers = {sid: js for _, _, sid, js in ride_registry_rows()}
    out = avro.decode_bodies(split, writers, v2)
    return out.select(F.col("ride_id").cast("bigint").alias("ride_id"), "pickup_city", "fare",
                      "status", "driver_rating", "problem")


# --- contract split on a stream ----------------------------------------------------


#: Rows of a staged file, and bytes of files that a micro-batch takes.
SPLIT_FILE_ROWS, SPLIT_BATCH_BYTES = 1 << 17, 512 << 20


@query("stream_contract_split")
def stream_contract_split(spark, sf_dir):
    """The damaged JSON records as a stream, split per micro-batch into an
    accepted and a quarantined table; both are returned, told apart by side."""
    records = rel.ride_json(spark, sf_dir)
    # a file is one task's work: many small ones keep all cores busy, and a micro-batch takes many
    src = runner.stage(records, "ride-json", file_rows=SPLIT_FILE_ROWS)
    stream = runner.file_stream(spark, src, records.schema, max_bytes=SPLIT_BATCH_BYTES)
    run = scontracts.split_stream(stream, "value", V1)
    nothing = F.lit(None).cast("string")
    good = spark.read.schema(run.accepted_schema).parquet(run.accepted_path)
    bad = spark.read.schema(run.quarantine_schema).parquet(run.quarantine_path)
    return good.select(F.lit("accepted").alias("side"), *V1_FIELDS, nothing.alias("violations")) \
        .unionByName(bad.select(F.lit("quarantined").alias("side"),
                                F.col("ride_id").cast("string").alias("ride_id"),
                                F.array_join("violations", ",").alias("violations")),
                     allowMissingColumns=True)


# --- queries over stored state, and over times -----------------------------------------

QUERIES.update(stored.QUERIES)
QUERIES.update(timing.QUERIES)
