"""A stream's own metrics as rows: per micro-batch input rows, watermark,
state rows and rows dropped by the watermark.

``numRowsDroppedByWatermark`` counts rows reaching the stateful operator,
after partial aggregation, so it counts groups, not input rows; input rows
dropped as late come from the batch operator ``late_drop_count``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

PROGRESS_SCHEMA = ("batch_id bigint, num_input_rows bigint, watermark timestamp_ntz, "
                   "num_state_rows bigint, num_dropped_by_watermark bigint, "
                   "num_dropped_duplicates bigint, observed_rows bigint")
OBSERVED = "rows_seen"   # name of the observe() metric set by the stream helpers


def _wm(p: dict):
    text = (p.get("eventTime") or {}).get("watermark")
    if not text:
        return None
    return dt.datetime.strptime(text, "%Y-%m-%dT%H:%M:%S.%fZ")


def progress_rows(spark: SparkSession, progress: list[dict]) -> DataFrame:
    """One row per progress report (a few per micro-batch at most)."""
    rows = []
    for p in progress:
        ops = p.get("stateOperators") or []
        observed = (p.get("observedMetrics") or {}).get(OBSERVED) or {}
        if hasattr(observed, "asDict"):
            observed = observed.asDict()
        rows.append((p["batchId"], p.get("numInputRows", 0), _wm(p),
                     sum(o.get("numRowsTotal", 0) for o in ops),
                     sum(o.get("numRowsDroppedByWatermark", 0) for o in ops),
                     sum((o.get("customMetrics") or {}).get("numDroppedDuplicateRows", 0)
                         for o in ops),
                     observed.get("rows")))
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)
