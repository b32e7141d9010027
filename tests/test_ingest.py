import pytest
import yaml

from tests.conftest import SF_SMALL
from tidemark.plans import ingest
from tidemark.session import fresh_dir


def test_unknown_connector_raises(spark):
    with pytest.raises(KeyError):
        ingest.run(spark, {"source": {"type": "postgres_magic"}, "sink": {"type": "parquet"}})


def test_defaults():
    cfg = {"source": {"type": "parquet", "options": {"path": "x"}}, "sink": {"type": "noop"}}
    assert ingest._trigger(cfg) == {"processingTime": "1 seconds"}
    assert ingest._trigger({**cfg, "interval_seconds": 5}) == {"processingTime": "5 seconds"}


def test_batch_config_from_yaml(spark, tmp_path):
    out = fresh_dir(spark, "ingest-batch")
    cfg = {
        "pipeline_name": "rides_batch",
        "source": {"type": "parquet", "options": {"path": f"{SF_SMALL}/events.parquet"}},
        "transforms": [{"type": "rides"}, {"type": "filter", "condition": "fare > 10"},
                       {"type": "select", "columns": ["ride_id", "fare"]}],
        "sink": {"type": "parquet", "options": {"path": out}},
    }
    path = tmp_path / "p.yaml"
    path.write_text(yaml.safe_dump(cfg))
    run = ingest.run(spark, ingest.load_config(str(path)))
    assert run.name == "rides_batch" and run.query is None
    got = spark.read.parquet(out)
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assert got.count() == ev.where("value > 10").count()
    assert got.columns == ["ride_id", "fare"]


def test_stream_config_json_value(spark):
    out = fresh_dir(spark, "ingest-stream")
    cfg = {
        "mode": "stream", "trigger": "available_now",
        "source": {"type": "parquet",
                   "options": {"path": SF_SMALL, "pathGlobFilter": "events.parquet"}},
        "transforms": [{"type": "rides"}, {"type": "select", "columns": ["ride_id", "status"]},
                       {"type": "json_value"}],
        "sink": {"type": "json", "options": {"path": out,
                                             "checkpointLocation": fresh_dir(spark, "ck")}},
    }
    run = ingest.run(spark, cfg)
    assert run.name == "unnamed_pipeline"
    assert spark.read.json(out).count() == 1000


def test_shipped_configs_build(spark):
    import glob
    import os
    root = os.path.join(os.path.dirname(os.path.dirname(__file__)), "configs")
    paths = sorted(glob.glob(f"{root}/*.yaml"))
    assert paths
    for p in paths:
        cfg = ingest.load_config(p)
        cfg["source"]["options"]["path"] = f"{SF_SMALL}/events.parquet"
        df = ingest.build(spark, cfg)
        assert df.isStreaming == (cfg.get("mode") == "stream")
        assert cfg["sink"]["type"] in ingest.connectors.SINKS


def test_runnable_config(spark):
    import os
    cfg = ingest.load_config(os.path.join(os.path.dirname(os.path.dirname(__file__)),
                                          "configs", "rides_to_parquet.yaml"))
    cfg["source"]["options"]["path"] = f"{SF_SMALL}/events.parquet"
    suffix = fresh_dir(spark, "x").rsplit("/", 1)[1]
    cfg["sink"]["options"] = {"path": f"cfg-out-{suffix}", "checkpointLocation": f"cfg-ck-{suffix}"}
    ingest.run(spark, cfg)
    from tidemark.session import checkpoint_root
    out = spark.read.parquet(f"{checkpoint_root(spark).rstrip('/')}/cfg-out-{suffix}")
    assert out.count() == 1000


def test_dedup_transform_batch_and_stream(spark):
    from pyspark.sql import functions as F
    src = fresh_dir(spark, "dup-src")
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, n int") \
        .coalesce(1).write.parquet(src)
    batch_cfg = {"source": {"type": "parquet", "options": {"path": src}},
                 "transforms": [{"type": "dedup", "keys": ["k"], "order": ["n"]}]}
    got = {r.k: r.n for r in ingest.build(spark, batch_cfg).collect()}
    assert got == {"a": 1, "b": 3}
    out = fresh_dir(spark, "dup-out")
    stream_cfg = {**batch_cfg, "mode": "stream", "trigger": "available_now",
                  "sink": {"type": "parquet",
                           "options": {"path": out, "checkpointLocation": fresh_dir(spark, "ck")}}}
    ingest.run(spark, stream_cfg)
    assert sorted(r.k for r in spark.read.parquet(out).select(F.col("k")).collect()) == ["a", "b"]
