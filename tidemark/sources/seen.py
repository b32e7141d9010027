"""The seen-keys table of incremental dedup: load, import, save.

Keys live in a Parquet table partitioned by run id.  A run writes its new
keys into its own partition with dynamic partition overwrite, so repeating
a run (after a crash) replaces its keys instead of adding them twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_COL = "run_id"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def load_seen(spark: SparkSession, path: str, key: str, key_type: str = "string",
              before_run: str | None = None) -> DataFrame:
    """Seen keys; an empty table when nothing was saved yet.  With
    ``before_run`` the run's own earlier attempt is left out (reruns)."""
    if not _exists(spark, path):
        return spark.createDataFrame([], f"{key} {key_type}")
    seen = spark.read.parquet(path)
    if before_run is not None:
        seen = seen.where(F.col(RUN_COL) != before_run)
    return seen.select(key)


def import_json_array(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Keys from a file holding one JSON array of strings (a legacy state
    file).  Each line is one array; a single-line file is one record."""
    text = spark.read.text(path)
    return text.select(F.explode(F.from_json("value", "array<string>")).alias(key))


def save_seen(keys: DataFrame, path: str, run_id: str) -> None:
    """Write this run's new keys as the run's partition (idempotent)."""
    keys.withColumn(RUN_COL, F.lit(run_id)).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(RUN_COL).parquet(path)
