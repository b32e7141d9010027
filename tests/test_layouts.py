"""Tables as one file and as a folder of part files give the same answers, and
rows with missing keys or times are kept or counted, never lost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, rows, srt
from tidemark.operators import contracts, delivery, eventtime, offsets, schemas
from tidemark.plans import ingest
from tidemark.plans.queries import QUERIES
from tidemark.session import fresh_dir
from tidemark.sources import connectors
from tidemark.streaming import progress, runner, windows


@pytest.fixture(scope="module")
def parts_dir(spark, tmp_path_factory):
    """The smallest tables with ``events`` as a folder of part files."""
    d = tmp_path_factory.mktemp("parts")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(5).write.parquet(f"{d}/events.parquet")
    return str(d)


@pytest.mark.parametrize("name", ["raw_scan", "stream_tumble_count", "watermark_policy", "configured_ingest"])
def test_one_file_or_many(spark, parts_dir, name):
    one, many = rows(QUERIES[name](spark, SF_SMALL)), rows(QUERIES[name](spark, parts_dir))
    assert one == many and one


def test_config_on_both_layouts(spark, parts_dir):
    config = ingest.load_config("configs/rides_to_parquet.yaml")
    for folder in (SF_SMALL, parts_dir):
        out = fresh_dir(spark, "cfg")
        config["source"]["options"]["path"] = f"{folder}/events.parquet"
        config["sink"]["options"] = {"path": out, "checkpointLocation": fresh_dir(spark, "cfg-ckpt")}
        ingest.run(spark, config)
        assert spark.read.parquet(out).count() == 1000


def test_a_changed_table_changes_the_replay(spark, tmp_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    counts = []
    for n in (300, 60):
        ev.orderBy("event_id").limit(n).write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
        counts.append(QUERIES["stream_late_replay"](spark, str(tmp_path)).agg(F.sum("ride_count")).first()[0])
    assert counts[0] > counts[1] > 0


def test_progress_of_more_than_a_hundred_batches(spark):
    src = fresh_dir(spark, "many-src")
    spark.range(130).repartition(130, "id").write.option("maxRecordsPerFile", 1).parquet(src)
    s = runner.file_stream(spark, src, spark.read.parquet(src).schema, max_files=1)
    run = runner.run_available_now(s, "many")
    p = progress.progress_rows(spark, run.progress).where("num_input_rows > 0")
    assert p.count() == 130 and p.agg(F.sum("num_input_rows")).first()[0] == 130


def test_rows_without_a_batch_arrive_last(spark):
    t = dt.datetime(2026, 1, 1)
    df = spark.createDataFrame([(1, "c", t, 1), (2, "c", t, None), (3, "c", t, 0)],
                               "ride_id int, pickup_city string, event_time timestamp, batch int")
    replay = windows.replay_batches(df, "batch", "nobatch")
    s = runner.file_stream(spark, replay.path, df.schema, max_files=replay.files_per_trigger)
    run = runner.run_available_now(s.select("ride_id"), "nobatch")
    assert rows(run.output) == [(1,), (2,), (3,)]


def test_offsets_of_null_keys(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (None, 0), (3, None)], "id int, part int")
    out = offsets.assign_offsets(df, "part", ["id"], F.expr("id div 2"))
    assert rows(out, "id", "part", "off") == srt([(None, 0, 0), (1, 0, 1), (2, 0, 2), (3, None, 0)])


def test_rows_without_event_time_are_counted(spark):
    t = dt.datetime(2026, 1, 1)
    df = spark.createDataFrame([(1, t, 0), (2, None, 0)], "id int, ts timestamp, b int")
    got = eventtime.late_drop_count(df, "ts", "b", "10 seconds", 5).first()
    assert (got.kept_rows, got.dropped_rows, got.no_event_time) == (1, 0, 1)
    c = eventtime.late_classify(df, "ts", "b", "10 seconds", 5)
    assert rows(c.select("id", "is_late", F.col("window_start").isNull().alias("n"))) == [(1, False, False), (2, False, True)]
    kept = eventtime.late_kept_closed(df.withColumn("k", F.lit(1)), "ts", ["k"], "b", "10 seconds", 0)
    assert kept.count() == 0


TYPED = schemas.Contract.parse("""{"type": "record", "name": "T", "fields": [
 {"name": "i", "type": "int"}, {"name": "l", "type": ["null", "long"], "default": null},
 {"name": "d", "type": "string", "default": "none"}]}""")


@pytest.mark.parametrize("text,want", [
    ('{"i": 1, "d": "x"}', []), ('{"i": 1}', []), ('{"i": 3000000000}', ["type:i"]),
    ('{"i": -2147483648, "l": 99999999999999999999}', ["type:l"]), ('{"i": 1, "l": 9223372036854775807}', []),
    ('{"d": "x"}', ["missing:i"]), ('{"i": null}', ["missing:i"])])
def test_ranges_and_defaults(spark, text, want):
    v = contracts.validate(spark.createDataFrame([(text,)], "value string"), "value", TYPED)
    assert list(v.first().violations) == want
    got = contracts.accepted(v, TYPED).collect()
    assert len(got) == (not want)
    for r in got:
        assert r.i is not None and r.d is not None


def test_contract_file_and_registry_outcomes(spark, tmp_path):
    (tmp_path / "v1.avsc").write_text(schemas.RIDE_V1)
    c = schemas.Contract.load(spark, f"file://{tmp_path}/v1.avsc")
    assert c == schemas.Contract.parse(schemas.RIDE_V1) and c.name.startswith("com.")
    assert schemas.check_registered([], "s", schemas.RIDE_V1) == ("nothing_registered", [])
    reg, _ = schemas.register([], "s", schemas.RIDE_V1)
    assert schemas.check_registered(reg, "s", schemas.RIDE_V2_SAFE)[0] == "compatible"
    assert schemas.check_registered(reg, "s", schemas.RIDE_V2_BREAKING)[0] == "incompatible"
    assert schemas.check_registered(reg, "s", "{}")[0] == "error"


def test_broker_names():
    name = "kafka.bootstrap.servers"
    assert connectors.broker_options({})[name] == connectors.DEFAULT_BROKERS
    assert connectors.broker_options({"bootstrap_servers": "a:1", "topic": "t"}) == {name: "a:1", "topic": "t"}
    assert connectors.broker_options({"bootstrap_servers": ["a:1", "b:2"]})[name] == "a:1,b:2"
    assert connectors.broker_options({name: "c:3"})[name] == "c:3"


def test_saved_state_replay_changes_nothing(spark):
    d = spark.createDataFrame([(k, 0, o) for o, k in enumerate(["a", "b", "a", None, "c", None])], "k string, part int, off bigint")
    out, seen = fresh_dir(spark, "o"), fresh_dir(spark, "s")
    delivery.incremental_run(d.where("off < 3"), seen, "k", ["part", "off"], out, "r1")
    for _ in range(2):
        two = delivery.incremental_run(d.where("off >= 2"), seen, "k", ["part", "off"], out, "r2")
        assert rows(two, "k", "off") == srt([(None, 3), ("c", 4)])
    assert spark.read.parquet(out).count() == 4


@pytest.mark.parametrize("order", [["part", "off"], ["off", "name"]])
def test_first_delivery_in_either_form(spark, order):
    """Packed integer order and struct order agree, nulls first."""
    data = [("a", 1, 5, "x"), ("a", 0, 9, "y"), ("b", None, 3, "z"), ("b", 0, 1, "w"), ("c", -1, None, "v"),
            ("c", -1, -4, "u"), (None, 2, 2, "t"), (None, 2, 1, "s")]
    d = spark.createDataFrame(data, "k string, part int, off bigint, name string").select("k", *order)
    flagged = delivery.flag_duplicates(d, "k", order)
    first = delivery.dedup_against_seen(d, d.where("k = 'a'").select("k"), "k", order)
    key = lambda r: tuple((r[c] is not None, r[c] if r[c] is not None else 0) for c in order)
    want = {}
    for r in d.collect():
        if r["k"] not in want or key(r) < key(want[r["k"]]):
            want[r["k"]] = r
    assert rows(flagged.where("not is_duplicate"), "k", *order) == srt([tuple(r) for r in want.values()])
    assert rows(first, "k", *order) == srt([tuple(r) for k, r in want.items() if k != "a"])
