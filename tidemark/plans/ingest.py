"""Config-driven ingest: a small config names a source, transforms and a
sink; one generic runner executes any such config.

    pipeline_name: rides_stream        # default "unnamed_pipeline"
    source: {type: parquet, options: {path: ...}}
    transforms: [{type: rides}, {type: select, columns: [...]}]
    sink:   {type: parquet, options: {path: ...}}
    mode: batch | stream                 # default batch
    interval_seconds: 1                  # stream trigger; default 1
    trigger: available_now               # optional: run what is there, stop

A stream's sink is always stopped in ``finally`` (the close hook).  The
driver only builds the plan; data moves on executors.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import delivery
from tidemark.sources import connectors
from tidemark.sources.relations import rides_from
from tidemark.functions.codec import json_encode
from tidemark.session import build_session, checkpoint_root, use_utc

DEFAULT_NAME = "unnamed_pipeline"
DEFAULT_INTERVAL_S = 1

Transform = Callable[[DataFrame, dict], DataFrame]
TRANSFORMS: dict[str, Transform] = {
    "select": lambda df, t: df.select(*t["columns"]),
    "filter": lambda df, t: df.where(F.expr(t["condition"])),
    "with_column": lambda df, t: df.withColumn(t["name"], F.expr(t["expr"])),
    "rides": lambda df, t: rides_from(df),
    "json_value": lambda df, t: df.select(json_encode(F.struct(*df.columns)).alias("value")),
    "dedup": lambda df, t: (df.dropDuplicates(t["keys"]) if df.isStreaming
                            else delivery.keep_first(df, t["keys"], t["order"])),
}


@dataclass
class IngestRun:
    name: str
    query: StreamingQuery | None


def load_config(path: str) -> dict:
    import yaml
    with open(path) as fh:
        return yaml.safe_load(fh)


def _trigger(config: dict) -> dict:
    if config.get("trigger") == "available_now":
        return {"availableNow": True}
    return {"processingTime": f"{config.get('interval_seconds', DEFAULT_INTERVAL_S)} seconds"}


def build(spark: SparkSession, config: dict) -> DataFrame:
    """The source with all transforms applied (lazy)."""
    streaming = config.get("mode", "batch") == "stream"
    df = connectors.build_source(spark, config["source"], streaming)
    for t in config.get("transforms") or []:
        df = TRANSFORMS[t["type"]](df, t)
    return df


def _resolve_paths(spark: SparkSession, options: dict) -> dict:
    """Relative sink paths and checkpoints resolve under the shared root."""
    out = dict(options)
    for k in ("path", "checkpointLocation"):
        v = out.get(k)
        if v and not v.startswith("/") and not re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", v):
            out[k] = f"{checkpoint_root(spark).rstrip('/')}/{v}"
    return out


def run(spark: SparkSession, config: dict, wait: bool = True) -> IngestRun:
    """Run one config.  Batch: write and return.  Stream: start; with
    ``wait`` block until the query ends (availableNow) and stop it."""
    name = config.get("pipeline_name", DEFAULT_NAME)
    df = build(spark, config)
    sink = connectors.build_sink(config["sink"])
    options = _resolve_paths(spark, config["sink"].get("options") or {})
    q = sink(df, options, _trigger(config))
    if q is not None and wait:
        try:
            q.awaitTermination()
        finally:
            q.stop()
    return IngestRun(name, q)


def main(argv: list[str]) -> int:
    """python -m tidemark.plans.ingest <config.yaml>"""
    if len(argv) != 2:
        print("usage: python -m tidemark.plans.ingest <config.yaml>")
        return 1
    spark = build_session()
    use_utc(spark)
    config = load_config(argv[1])
    result = run(spark, config)
    print(f"{result.name}: done")
    return 0


if __name__ == "__main__":
    import sys
    sys.exit(main(sys.argv))
