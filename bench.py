"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each batch query is executed in full (noop sink) once to warm up, then
$BENCH_RUNS times; the median is reported.  Stream queries run once per
measurement with fresh checkpoints (a full availableNow run each).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "flagship", "raw_scan", "bounded_scan", "iso_parse", "json_topic_decode",
    "duplicate_audit", "duplicate_flag", "dedup_keep_first", "dedup_keep_first_lineitem",
    "dedup_incremental", "run_summary", "crash_replay", "resume_from_offsets",
    "tumble_count", "tumble_count_closed", "watermark_trace", "late_classify",
    "late_drop_count", "contract_validate", "contract_accept", "contract_summary",
    "frame_split", "frame_route", "consumer_lag", "topic_rate", "offset_progress",
    "scrape_grid", "stream_tumble_count", "stream_dedup", "dedup_saved_state", "schema_compat",
    "avro_decode", "configured_ingest", "stream_dedup_bounded", "stream_contract_split",
    "watermark_policy", "stream_late_replay",
]
ONCE = {"stream_late_replay", "watermark_policy", "stream_dedup_bounded"}   # many micro-batches
STREAMS = {"stream_tumble_count", "stream_dedup", "dedup_saved_state", "configured_ingest",
           "stream_dedup_bounded", "stream_contract_split", "watermark_policy", "stream_late_replay"}


def main() -> None:
    from tidemark.session import build_session
    from tidemark.plans.queries import QUERIES

    spark = build_session(master=f"local[{CPUS}]", shuffle_partitions=CPUS)
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in HEADLINE:
        fn = QUERIES[name]
        samples = []
        if name in STREAMS:
            for _ in range(1 if name in ONCE else max(1, RUNS - 1)):
                t0 = time.perf_counter()
                fn(spark, SF_DIR).write.format("noop").mode("overwrite").save()
                samples.append(time.perf_counter() - t0)
        else:
            t0 = time.perf_counter()
            fn(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            cold[name] = round(time.perf_counter() - t0, 3)
            for _ in range(RUNS):
                t0 = time.perf_counter()
                fn(spark, SF_DIR).write.format("noop").mode("overwrite").save()
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum of median query seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "first_run": cold,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": CPUS,
        "shuffle_partitions": CPUS,
        "runs": RUNS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
