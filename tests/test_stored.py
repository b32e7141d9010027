"""Stored state: commit log, key store, log stored by offset."""

import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, srt
from tidemark.operators import delivery
from tidemark.session import fresh_dir
from tidemark.sources.commits import CommitLog
from tidemark.sources.keystore import KeyStore, RunConflict, not_in_store
from tidemark.sources.offset_log import end_offsets, scan_from, store_log


def test_one_of_two_commits_wins(spark):
    log = CommitLog(spark, fresh_dir(spark, "commits"))
    assert log.latest() == 0
    for n in (1, 2, 3):
        with ThreadPoolExecutor(4) as pool:
            won = list(pool.map(lambda w: log.put(n, f"{n} by {w} é"), range(4)))
        assert sum(won) == 1 and log.read(n) == f"{n} by {won.index(True)} é"
    assert log.latest() == 3 and not log.put(2, "again")


def run_rows(spark, keys, run):
    return spark.createDataFrame([(k, run, i) for i, k in enumerate(keys)], "k string, part int, off bigint")


def test_runs_against_stored_keys(spark):
    store = KeyStore(spark, fresh_dir(spark, "keys"), "string", buckets=3, fanout=2)
    out, taken, want = fresh_dir(spark, "rows"), set(), []
    for n, keys in enumerate([["a", "b", None, "a"], ["b", "c", None, ""], [], ["d", "c", "e", "d"], ["a", "f"], ["g", None]]):
        got = delivery.stored_run(run_rows(spark, keys, n), store, "k", ["part", "off"], out, f"r{n}")
        new = [(k, n, keys.index(k)) for k in dict.fromkeys(keys) if k not in taken]
        taken |= set(keys)
        assert rows(got) == srt(new)
        want += new
    assert rows(spark.read.parquet(out).select("k", "part", "off")) == srt(want)
    assert rows(store.keys(), "_tm_key") == srt([(k,) for k in taken])
    # merged, but for the newest run
    segments = store.state()[1]["segments"]
    assert max(s["level"] for s in segments) >= 2 and [s["run"] for s in segments if s["level"] == 0][-1] == "r5"
    assert len(segments) <= 4
    # the newest run again: same rows, no key twice; an older one can't be told apart any more
    again = delivery.stored_run(run_rows(spark, ["g", None], 5), store, "k", ["part", "off"], out, "r5")
    assert rows(again, "k") == [("g",)] and store.keys().count() == len(taken)
    with pytest.raises(RunConflict):
        delivery.stored_run(run_rows(spark, ["x"], 9), store, "k", ["part", "off"], out, "r2")
    assert store.vacuum(1) > 0 and rows(store.keys(), "_tm_key") == srt([(k,) for k in taken])
    # its bucket count is the store's, whatever is asked for later
    assert KeyStore(spark, store.path, "string", buckets=50).buckets == 3


def test_concurrent_runs_conflict(spark):
    store = KeyStore(spark, fresh_dir(spark, "keys"), "bigint", buckets=2)
    read, _ = store.state()
    keys = spark.range(5).select(F.col("id").alias("k"))
    store.commit("one", keys, read)
    with pytest.raises(RunConflict):
        store.commit("two", keys, read)
    assert store.keys().count() == 5


def test_saved_keys_are_not_moved(spark):
    store = KeyStore(spark, fresh_dir(spark, "keys"), "bigint", buckets=6, fanout=2)
    out = fresh_dir(spark, "rows")
    for n in range(4):
        inc = spark.range(n * 50, n * 50 + 100).select(F.col("id").alias("k"), F.lit(n).alias("part"), F.col("id").alias("off"))
        delivery.stored_run(inc, store, "k", ["part", "off"], out, f"r{n}")
    new = not_in_store(delivery.keep_first(inc, "k", ["part", "off"]), "k", store.keys())
    new.write.format("noop").mode("overwrite").save()
    plan = new._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    join = plan[plan.index("ShuffledHashJoin"):]
    seen = re.split(r"\n[ :]*\+- ", join)
    scan = next(i for i, line in enumerate(seen) if "FileScan parquet spark_catalog" in line)
    # exchanges belong to the run's own rows; the store is read by bucket
    assert "Bucketed: true" in seen[scan] and "SelectedBucketsCount: 6 out of 6" in seen[scan]
    assert "Exchange" not in join[join.index("\n", join.rindex("Exchange")):join.index("FileScan parquet spark_catalog")]
    assert len(re.findall(r"\bExchange hashpartitioning", plan)) <= 2
    assert not any("Exchange" in line for line in seen[scan - 3:scan])
    assert "Sort [_tm_hash" not in plan


def test_resuming_skips_what_was_committed(spark):
    d = spark.range(400_000).select((F.col("id") % 3).cast("int").alias("part"), F.floor(F.col("id") / 3).alias("off"),
                                    F.sha2(F.col("id").cast("string"), 256).alias("value"))
    path = store_log(d, fresh_dir(spark, "log"), row_group=1 << 18)
    ends = end_offsets(spark, path)
    assert rows(ends) == srt([(0, 133334), (1, 133333), (2, 133333)])
    back = scan_from(spark, path, ends.select("part", F.floor(F.col("end_offset") * .9).cast("bigint").alias("committed")))
    assert back.count() == sum(n - int(n * .9) for n in (133334, 133333, 133333))
    size = back.select(F.sum(F.length("value")))
    size.collect()
    node, read = size._jdf.queryExecution().executedPlan(), []

    def scans(n):
        if "FileSourceScan" in n.getClass().getSimpleName():
            read.append(n.metrics().apply("numOutputRows").value())
        if "AdaptiveSparkPlan" in n.getClass().getSimpleName() or "QueryStage" in n.getClass().getSimpleName():
            scans(n.executedPlan() if hasattr(n, "executedPlan") and "Adaptive" in n.getClass().getSimpleName() else n.plan())
        for i in range(n.children().size()):
            scans(n.children().apply(i))

    scans(node)
    assert read and sum(read) < .25 * 400_000
    # nothing committed in partition 1, partition 2 unknown: both whole
    some = spark.createDataFrame([(0, 133330), (1, None)], "part int, committed bigint")
    assert rows(scan_from(spark, path, some).groupBy("part").count()) == srt([(0, 4), (1, 133333), (2, 133333)])


def test_rows_without_a_partition_are_read(spark):
    d = spark.createDataFrame([(None, 0), (None, 1), (0, 0)], "part int, off bigint")
    path = store_log(d, fresh_dir(spark, "log"))
    none = spark.createDataFrame([], "part int, committed bigint")
    assert scan_from(spark, path, none).count() == 3
    some = spark.createDataFrame([(None, 1), (0, 1)], "part int, committed bigint")
    assert rows(scan_from(spark, path, some)) == [(None, 1)]


def test_concurrent_registrations(spark):
    from tidemark.operators import schemas as S
    from tidemark.sources.registry import Registry
    path = fresh_dir(spark, "registry")
    with ThreadPoolExecutor(6) as pool:
        told = list(pool.map(lambda n: Registry(spark, path).register(f"s{n % 3}", S.RIDE_V1), range(6)))
    # three subjects get three ids; of two equal registrations one gets the other's id
    assert sorted(t["status"] for t in told) == ["exists"] * 3 + ["registered"] * 3
    assert all(told[n]["schema_id"] == told[n + 3]["schema_id"] for n in range(3))
    assert {t["schema_id"] for t in told} == {1, 2, 3}
    registry = Registry(spark, path)
    assert registry.register("s0", S.RIDE_V2_BREAKING)["status"] == "incompatible"
    assert registry.register("s0", S.RIDE_V2_SAFE) == {"status": "registered", "version": 2, "schema_id": 4}
    with pytest.raises(ValueError):
        registry.register("s0", '{"type": "string"}')
    assert Registry(spark, path).check("s0", S.RIDE_V1)[0] == "compatible"
    assert Registry(spark, path).check("none", S.RIDE_V1)[0] == "nothing_registered"
    table = registry.table()
    assert rows(table, "subject", "version", "schema_id") == srt(
        [(f"s{n}", 1, told[n]["schema_id"]) for n in range(3)] + [("s0", 2, 4)])
    assert {r.schema_json for r in table.collect()} == {S.canonical(S.RIDE_V1), S.canonical(S.RIDE_V2_SAFE)}


def test_registry_tool(spark, tmp_path, capsys):
    from tidemark.operators import schemas as S
    from tidemark.sources.registry import Registry, main
    path = fresh_dir(spark, "registry")
    assert Registry(spark, path).table().count() == 0 and Registry(spark, path).rows() == []
    for name, text in (("v1", S.RIDE_V1), ("breaking", S.RIDE_V2_BREAKING)):
        (tmp_path / name).write_text(text)
    calls = [("check", "v1"), ("register", "v1"), ("check", "breaking"), ("register", "breaking"), ("register", "v1")]
    codes = [main([do, path, "rides", str(tmp_path / name)], spark) for do, name in calls]
    assert codes == [0, 0, 1, 1, 0] and main(["drop", path], spark) == 2
    said = [line.split('"status": "')[1].split('"')[0] for line in capsys.readouterr().out.splitlines()]
    assert said == ["nothing_registered", "registered", "incompatible", "incompatible", "exists"]


def record(i, **changes):
    import json
    doc = {"ride_id": str(i), "rider_name": "r", "pickup_city": "c", "dropoff_city": "d", "fare": 1.5, "status": "ok", "event_time": "t"}
    return json.dumps({k: v for k, v in (doc | changes).items() if v is not None})


def test_refused_records_move_once(spark):
    from tidemark.operators.schemas import RIDE_V1, RIDE_V2_STATUS, Contract
    from tidemark.sources.split_store import SplitStore
    v1, v2 = Contract.parse(RIDE_V1), Contract.parse(RIDE_V2_STATUS)
    store = SplitStore(spark, fresh_dir(spark, "split"))
    assert store.accepted(v2).count() == 0 and not store.replay("early", "value", v2)
    texts = [record(0), record(1, status=None), record(2, fare="x"), record(3, status=None, fare="x"), "no json", None, record(1, status=None)]
    batch = spark.createDataFrame([(t,) for t in texts], "value string")
    assert store.ingest("b", batch, "value", v1) and not store.ingest("b", batch, "value", v1)
    assert rows(store.accepted(v1), "ride_id") == [("0",)] and store.refused().count() == 6
    assert store.replay("v2", "value", v2)
    assert rows(store.accepted(v2), "ride_id", "status") == srt([("0", "ok"), ("1", None), ("1", None)])
    assert rows(store.refused(), "violations") == srt([(["type:fare"],), (["type:fare"],), (["malformed"],), (["malformed"],)])
    before = store.state()
    assert not store.replay("v2", "value", v2) and store.state() == before
    # under another name it moves nothing either: what is refused stays refused
    assert store.replay("v2 again", "value", v2)
    assert store.accepted(v2).count() == 3 and store.refused().count() == 4
    # a batch that comes between a replay's reading and its commit stays
    assert store.ingest("c", batch, "value", v1)
    assert store.accepted(v2).count() == 4 and store.refused().count() == 10


def test_of_two_replays_of_the_same_records_one_counts(spark):
    from tidemark.operators.schemas import RIDE_V1, RIDE_V2_STATUS, Contract
    from tidemark.sources.split_store import SplitStore
    v1, v2 = Contract.parse(RIDE_V1), Contract.parse(RIDE_V2_STATUS)
    path = fresh_dir(spark, "split")
    store = SplitStore(spark, path)
    store.ingest("b", spark.createDataFrame([(record(i, status=None),) for i in range(20)], "value string"), "value", v1)
    with ThreadPoolExecutor(2) as pool:
        won = list(pool.map(lambda n: SplitStore(spark, path).replay(n, "value", v2), ["one", "two"]))
    # side by side one of them finds its records taken; one after the other the second moves nothing
    assert any(won) and store.accepted(v2).count() == 20 and store.refused().count() == 0


def test_audits_merge(spark):
    from tidemark.operators.audit import block_sketches, merged_audit
    log = spark.range(60_000).select((F.col("id") % 3).cast("int").alias("part"), F.floor(F.col("id") / 3).alias("off"),
                                     F.when(F.col("id") % 50 != 0, F.col("id") % 30_000).alias("k"))
    kept = block_sketches(log, "k", "part", "off", 1000)
    assert kept.count() == 60
    for some in (kept, kept.where("part = 1"), kept.where("block < 7"), kept.where("block between 3 and 5 and part != 0")):
        got = merged_audit(some).first()
        want = delivery.duplicate_audit(log.withColumn("block", F.floor(F.col("off") / 1000)).join(
            some.select("part", "block"), ["part", "block"], "left_semi"), "k").first()
        assert got.processed == want.processed and abs(got.unique_rides - want.unique_rides) <= got.most_error < .03 * want.unique_rides + 2
    assert tuple(merged_audit(kept.limit(0)).first())[:3] == (0, 0, 0)
    # few keys are exact, null is one
    few = spark.createDataFrame([(0, 0, None), (0, 1, "a"), (0, 2, "a"), (0, 3, None), (0, 4, "")], "part int, off bigint, k string")
    assert tuple(merged_audit(block_sketches(few, "k", "part", "off", 2)).first())[:3] == (5, 3, 2)


def test_state_figures(spark):
    from tidemark.streaming import dedup, runner, state
    source = runner.stage(spark.range(1000).select((F.col("id") % 300).alias("k")), "state-source")
    run = runner.run_available_now(dedup.dedup(runner.file_stream(spark, source, spark.read.parquet(source).schema), ["k"]), "state")
    figures = state.state_figures(spark, run.checkpoint)
    assert figures.agg(F.sum("keys")).first()[0] == 300
    parts = state.operators(spark, run.checkpoint).first().numPartitions
    assert abs(figures.agg(F.sum("share")).first()[0] - parts) < 1e-9
    assert rows(state.state(spark, run.checkpoint).select("key.k")) == srt([(i,) for i in range(300)])
