"""Plan properties that matter at scale, checked on the physical plans."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tidemark.operators import delivery
from tidemark.plans.queries import QUERIES
from tidemark.sources import relations as rel

STREAMS = {n for n in QUERIES if n.startswith("stream_")} | {
    "watermark_policy", "configured_ingest", "schema_compat", "avro_decode"}
BATCH = sorted(set(QUERIES) - STREAMS)


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_products(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(E.queries()["raw_scan"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("props" not in s and "event_type" not in s for s in schemas)


def test_watermark_subquery_reads_one_column(spark):
    plan = _plan(E.queries()["tumble_count_closed"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_keep_first_aggregates_before_the_shuffle(spark):
    d = rel.deliveries(spark, SF_SMALL).select("ride_id", "part", "off", "fare")
    plan = _plan(delivery.keep_first(d, "ride_id", ["part", "off"]))
    # a partial aggregate by key sits under the exchange on the key
    assert re.search(r"Exchange hashpartitioning\(ride_id#\d+L?, \d+\)[\s\S]*partial_min", plan)


@pytest.mark.parametrize("name", ["duplicate_flag", "dedup_incremental", "run_summary", "crash_replay"])
def test_orders_of_numbers_aggregate_by_hash(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


@pytest.mark.parametrize("name,scans", [("dedup_incremental", 2), ("crash_replay", 2), ("resume_from_offsets", 2),
                                        ("run_summary", 2), ("consumer_lag", 2)])
def test_the_log_is_built_once(spark, name, scans):
    """One scan for the rows and one for the block counts, which give the end offsets too."""
    df = E.queries()[name](spark, SF_SMALL)
    df.collect()  # the plan as it ran, with what it used again
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in plan
    assert plan.count("FileScan parquet") <= scans


def test_hot_key_results(spark):
    """One key holding a third of the rows: results stay whole and exact."""
    from pyspark.sql import functions as F
    base = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("ride_id"),
        (F.col("id") % 4).cast("int").alias("part"), F.col("id").alias("off"))
    first = delivery.keep_first(base, "ride_id", ["part", "off"])
    assert first.count() == 2001
    assert first.where("ride_id = -1").first().off == 0
    flags = delivery.flag_duplicates(base, "ride_id", ["part", "off"])
    assert flags.where("is_duplicate").count() == 999
    audit = delivery.duplicate_audit(base, "ride_id").first()
    assert (audit.processed, audit.unique_rides, audit.duplicates) == (3000, 2001, 999)
