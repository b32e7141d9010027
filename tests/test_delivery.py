from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, rows, srt
from tidemark.operators import delivery
from tidemark.operators.offsets import assign_offsets
from tidemark.sources import relations as rel


def _log(spark, keys, start=0):
    return spark.createDataFrame([(k, 0, start + i) for i, k in enumerate(keys)],
                                 "ride_id string, part int, off bigint")


def test_dedup_two_runs(spark):
    empty = spark.createDataFrame([], "ride_id string")
    run1 = _log(spark, ["a", "a", "b", None, None])
    out1 = delivery.dedup_against_seen(run1, empty, "ride_id", ["part", "off"])
    assert rows(out1, "ride_id", "off") == srt([("a", 0), ("b", 2), (None, 3)])
    s1 = delivery.run_summary(run1, empty, "ride_id", ["part", "off"]).first()
    assert (s1.known_before, s1.processed, s1.skipped) == (0, 3, 2)
    seen = out1.select("ride_id")
    run2 = _log(spark, ["a", "c"], start=5)
    out2 = delivery.dedup_against_seen(run2, seen, "ride_id", ["part", "off"])
    assert rows(out2, "ride_id") == [("c",)]
    s2 = delivery.run_summary(run2, seen, "ride_id", ["part", "off"]).first()
    assert (s2.known_before, s2.processed, s2.skipped) == (3, 1, 1)


def test_duplicate_audit_null_is_one_key(spark):
    a = delivery.duplicate_audit(_log(spark, ["a", "a", "b", None, None]), "ride_id").first()
    assert (a.processed, a.unique_rides, a.duplicates) == (5, 3, 2)


def test_keep_first_total_order_multicolumn(spark):
    df = spark.createDataFrame([(1, 1, 9.0, "z"), (1, 1, 3.0, "y"), (1, 1, 3.0, "a"),
                                (1, 2, 5.0, None), (2, 1, None, "q"), (2, 1, 1.0, "q")],
                               "k1 int, k2 int, x double, s string")
    got = rows(delivery.keep_first(df, ["k1", "k2"], ["x", "s"]))
    assert got == srt([(1, 1, 3.0, "a"), (1, 2, 5.0, None), (2, 1, None, "q")])


def test_flag_duplicates_matches_row_number(spark):
    d = rel.deliveries(spark, SF_SMALL).select("ride_id", "part", "off")
    ours = delivery.flag_duplicates(d, "ride_id", ["part", "off"])
    w = Window.partitionBy("ride_id").orderBy("part", "off")
    brute = d.withColumn("is_duplicate", F.row_number().over(w) > 1)
    assert rows(ours) == rows(brute.select(*ours.columns))


def test_assign_offsets_matches_row_number(spark):
    r = rel.rides(spark, SF_SMALL).select("ride_id", "user_id")
    d = r.withColumn("part", (F.col("user_id") % 3).cast("int"))
    ours = assign_offsets(d, "part", ["ride_id"], F.floor(F.col("ride_id") / 37), "off")
    w = Window.partitionBy("part").orderBy("ride_id")
    brute = d.withColumn("off", F.row_number().over(w).cast("bigint") - 1)
    assert rows(ours, "ride_id", "part", "off") == rows(brute, "ride_id", "part", "off")


def test_resume_from_offsets_missing_commit_reads_all(spark):
    log = spark.createDataFrame([(p, o) for p in (0, 1) for o in range(5)], "part int, off bigint")
    committed = spark.createDataFrame([(0, 3)], "part int, committed bigint")
    got = rows(delivery.resume_from_offsets(log, committed, "part", "off"))
    assert got == srt([(0, 3), (0, 4)] + [(1, o) for o in range(5)])


def test_replay_audit(spark):
    log = _log(spark, ["a", "b", "c", "d", "e"])
    r = delivery.replay_audit(log, "ride_id", "off", processed_upto=4, committed=2).first()
    assert (r.naive_processed, r.idempotent_processed, r.double_processed) == (7, 5, 2)


def test_incremental_runs_with_saved_state(spark, tmp_path):
    from tidemark.session import fresh_dir
    from tidemark.sources.seen import import_json_array, load_seen
    seen_path, out_path = fresh_dir(spark, "seen"), fresh_dir(spark, "out")
    assert load_seen(spark, seen_path, "ride_id").count() == 0
    run1 = _log(spark, ["a", "a", "b", None, None])
    got1 = delivery.incremental_run(run1, seen_path, "ride_id", ["part", "off"], out_path, "r1")
    assert rows(got1, "ride_id") == srt([("a",), ("b",), (None,)])
    # the same run again (after a crash) changes nothing
    again = delivery.incremental_run(run1, seen_path, "ride_id", ["part", "off"], out_path, "r1")
    assert again.count() == 3 and load_seen(spark, seen_path, "ride_id").count() == 3
    run2 = _log(spark, ["a", "c"], start=5)
    got2 = delivery.incremental_run(run2, seen_path, "ride_id", ["part", "off"], out_path, "r2")
    assert rows(got2, "ride_id") == [("c",)]
    assert spark.read.parquet(out_path).count() == 4
    # a legacy JSON-array state file imports as keys
    f = tmp_path / "seen.json"
    f.write_text('["a", "c", "zz"]')
    assert rows(import_json_array(spark, str(f), "ride_id")) == [("a",), ("c",), ("zz",)]
