"""Loading the given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


_SCHEMAS: dict[tuple[str, int], StructType] = {}


def _mtime(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(p).getModificationTime()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; column pruning and filters reach the parquet scan.

    The schema is read once per file version; later reads pass it in and
    skip schema inference.
    """
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (path, _mtime(spark, path))
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def table_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                 **options) -> DataFrame:
    """A table as a file stream, whichever way it is laid out: a folder of part
    files is the source itself, a single file is picked out of its folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    r = spark.readStream.format(fmt).schema(schema).options(**options)
    if fs.exists(p) and not fs.getFileStatus(p).isDirectory():
        return r.option("pathGlobFilter", p.getName()).load(p.getParent().toString())
    return r.load(path)
