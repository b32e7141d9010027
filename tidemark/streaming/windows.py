"""Event-time tumbling counts on streams, late-data replay, watermark policy.

A stream keeps one watermark per source (the max event time over its
partitions, minus the delay), so an idle Kafka partition cannot stall it.
A union of sources combines their watermarks with
``spark.sql.streaming.multipleWatermarkPolicy``: ``min`` (default, safe: the
slowest source holds everything back) or ``max``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import fresh_dir, session_with
from tidemark.streaming.progress import OBSERVED
from tidemark.streaming.runner import StreamRun, file_stream, run_available_now

POLICY_CONF = "spark.sql.streaming.multipleWatermarkPolicy"


def with_event_time(stream: DataFrame, ts: str, delay_seconds: float) -> DataFrame:
    """Rows without an event time belong to no window and leave the stream here;
    ``eventtime.late_drop_count`` counts them on the batch side."""
    return stream.where(F.col(ts).isNotNull()).withWatermark(ts, f"{delay_seconds} seconds")


def tumble_count(stream: DataFrame, ts: str, keys: Sequence[str], width: str,
                 count_col: str = "ride_count") -> DataFrame:
    """Windowed count of a watermarked stream; in append mode a window's row
    is written once, when the watermark passes its end."""
    g = stream.groupBy(F.window(ts, width).alias("w"), *keys) \
        .agg(F.count(F.lit(1)).alias(count_col))
    return g.select(F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"), *keys, count_col)


@dataclass
class Replay:
    """A log laid out for replay: read it with ``files_per_trigger`` files
    per trigger and every micro-batch is exactly one arrival batch."""
    path: str
    files_per_trigger: int
    batches: int


def replay_batches(df: DataFrame, batch_col: str, label: str) -> Replay:
    """Lay ``df`` out as an arriving log, one arrival batch per micro-batch.

    All batches are written in one parallel job (``partitionBy`` the batch;
    no batch is gathered into one task, however large).  Every batch folder
    is then brought to the same file count K by adding schema-only parquet
    files, and the files of batch i get modification time t0 + i seconds
    (metadata only).  A file stream taking K files per trigger, oldest
    first, then sees exactly one arrival batch per micro-batch, in order.
    """
    spark = df.sparkSession
    src = fresh_dir(spark, f"{label}-src")
    df.write.partitionBy(batch_col).parquet(src)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(src)
    fs = root.getFileSystem(conf)
    batches = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(f"{batch_col}="):
            files = [f.getPath() for f in fs.listStatus(st.getPath())
                     if f.getPath().getName().endswith(".parquet")]
            value = name.split("=", 1)[1]
            # rows without a batch arrive after all others
            at = math.inf if value == "__HIVE_DEFAULT_PARTITION__" else int(value)
            batches.append((at, st.getPath(), files))
    batches.sort(key=lambda b: b[0])
    k = max((len(f) for _, _, f in batches), default=1)
    if any(len(f) < k for _, _, f in batches):
        tmpl_dir = fresh_dir(spark, f"{label}-empty")
        df.drop(batch_col).limit(0).coalesce(1).write.parquet(tmpl_dir)
        tmpl = next(f.getPath() for f in fs.listStatus(jvm.org.apache.hadoop.fs.Path(tmpl_dir))
                    if f.getPath().getName().endswith(".parquet"))
        for _, d, files in batches:
            for i in range(k - len(files)):
                pad = jvm.org.apache.hadoop.fs.Path(d, f"part-pad-{i:05d}.parquet")
                jvm.org.apache.hadoop.fs.FileUtil.copy(fs, tmpl, fs, pad, False, conf)
                files.append(pad)
    t0 = fs.getFileStatus(root).getModificationTime() - 1000 * (len(batches) + 1)
    for i, (_, _, files) in enumerate(batches):
        for f in files:
            fs.setTimes(f, t0 + 1000 * i, -1)
    return Replay(src, k, len(batches))


def late_replay(df: DataFrame, ts: str, keys: Sequence[str], batch_col: str, width: str,
                delay_seconds: float, label: str = "late-replay") -> StreamRun:
    """Replay ``df`` batch by batch through a watermarked windowed count."""
    replay = replay_batches(df, batch_col, label)
    stream = file_stream(df.sparkSession, replay.path, df.schema,
                         max_files=replay.files_per_trigger)
    stream = stream.observe(OBSERVED, F.count(F.lit(1)).alias("rows"))
    counts = tumble_count(with_event_time(stream, ts, delay_seconds), ts, keys, width)
    return run_available_now(counts, label)


def union_count(sources: Callable[[SparkSession], Sequence[DataFrame]], spark: SparkSession,
                ts: str, keys: Sequence[str], width: str, delay_seconds: float, policy: str,
                label: str = "union") -> StreamRun:
    """Windowed count over a union of watermarked sources under a policy.  The
    sources are built in a session of their own, which holds the policy."""
    marked = [with_event_time(s, ts, delay_seconds)
              for s in sources(session_with(spark, **{POLICY_CONF.replace(".", "__"): policy}))]
    u = marked[0]
    for s in marked[1:]:
        u = u.unionByName(s)
    return run_available_now(tumble_count(u, ts, keys, width), f"{label}-{policy}")
