"""Running streams to completion and reading their output back.

Streams write to a Parquet file sink (exactly-once: the sink's commit log and
the checkpoint's offsets and state move together), with ``availableNow`` so
a run takes everything present and stops.  Sink and checkpoint folders are
fresh paths under the shared checkpoint root.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from tidemark.session import fresh_dir
from tidemark.sources.tables import table_stream


@dataclass
class StreamRun:
    output: DataFrame
    progress: list[dict] = field(default_factory=list)
    sink_path: str = ""
    checkpoint: str = ""


def events_stream(spark: SparkSession, sf_dir: str, schema: StructType,
                  max_files: int | None = None) -> DataFrame:
    """The given ``events`` table as a file stream, one file or many."""
    options = {"maxFilesPerTrigger": max_files} if max_files else {}
    return table_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet", schema, **options)


def file_stream(spark: SparkSession, path: str, schema: StructType,
                max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Part files of a folder as a stream; micro-batches are cut by their number
    or by size."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        r = r.option("maxBytesPerTrigger", max_bytes)
    return r.parquet(path)


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None, file_rows: int | None = None) -> str:
    """Write a batch DataFrame as a table in the shared folder, in files of at most
    ``file_rows`` rows; returns its path."""
    path = fresh_dir(df.sparkSession, label)
    w = df.write.mode("error")
    if file_rows:
        w = w.option("maxRecordsPerFile", file_rows)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


class AllProgress(StreamingQueryListener):
    """Every progress report of the queries of a session, by run.  (A query
    itself keeps the last 100 or so only.)"""

    def __init__(self):
        self.reports: dict[str, list[dict]] = {}
        self.ended: dict[str, threading.Event] = {}

    def _end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event):
        self._end(str(event.runId))

    def onQueryProgress(self, event):
        p = json.loads(event.progress.json)
        self.reports.setdefault(p["runId"], []).append(p)

    def onQueryTerminated(self, event):
        self._end(str(event.runId)).set()

    def of(self, run: str, wait_s: float = 120) -> list[dict]:
        """All reports of an ended run; its last event comes after them."""
        if not self._end(run).wait(wait_s):
            raise TimeoutError(f"no end of streaming run {run} was reported")
        return self.reports.get(run, [])


def run_available_now(stream: DataFrame, label: str, output_mode: str = "append",
                      checkpoint: str | None = None, sink_path: str | None = None) -> StreamRun:
    """Run ``stream`` over all available input into a Parquet sink; returns the
    committed output read back plus a progress report per micro-batch.
    Rerunning with the same checkpoint and sink continues where the last run
    stopped.

    State partitions are the session's ``spark.sql.shuffle.partitions`` when
    the checkpoint is created and stay what they are; for another number build
    the stream on ``session_with(spark, ...)``.
    """
    spark = stream.sparkSession
    sink_path = sink_path or fresh_dir(spark, f"{label}-out")
    checkpoint = checkpoint or fresh_dir(spark, f"{label}-ckpt")
    seen = AllProgress()
    spark.streams.addListener(seen)
    try:
        q = (stream.writeStream.format("parquet")
             .option("path", sink_path)
             .option("checkpointLocation", checkpoint)
             .outputMode(output_mode)
             .trigger(availableNow=True)
             .start())
        q.awaitTermination()
        progress = seen.of(str(q.runId))
    finally:
        spark.streams.removeListener(seen)
    out = spark.read.schema(stream.schema).parquet(sink_path)
    return StreamRun(out, progress, sink_path, checkpoint)


def run_in_arrivals(df: DataFrame, batch_col: str, build: Callable[[DataFrame], DataFrame], label: str) -> StreamRun:
    """Run the stream that ``build`` makes over ``df`` as it arrives: the rows of each ``batch_col``
    (few values) are appended to a folder, and the stream takes them in a run of its own that
    goes on from the last one's checkpoint.  Rows without a batch arrive first."""
    spark = df.sparkSession
    source, sink, checkpoint = (fresh_dir(spark, f"{label}-{k}") for k in ("arrived", "out", "ckpt"))
    staged = spark.read.schema(df.schema).parquet(stage(df, f"{label}-rows"))
    progress: list[dict] = []
    run = None
    for (batch,) in staged.select(batch_col).distinct().orderBy(F.col(batch_col).asc_nulls_first()).collect():
        staged.where(F.col(batch_col).eqNullSafe(F.lit(batch))).write.mode("append").parquet(source)
        run = run_available_now(build(file_stream(spark, source, df.schema)), label, checkpoint=checkpoint, sink_path=sink)
        progress += run.progress
    if run is None:  # nothing arrived
        spark.createDataFrame([], df.schema).write.parquet(source)
        run = run_available_now(build(file_stream(spark, source, df.schema)), label, checkpoint=checkpoint, sink_path=sink)
    return StreamRun(run.output, progress, sink, checkpoint)
