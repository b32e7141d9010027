"""Helpers the operators of this folder share."""

from __future__ import annotations

import ctypes
import functools
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import fresh_dir


def by_value(module: str) -> None:
    """Ship ``module``'s functions to executors with the task, so that executors need no
    installed copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)


def released(run):
    """``run`` (for mapInArrow), with the memory it has freed given back when its task ends: workers
    live on for other tasks, and what they keep adds up in an executor."""
    @functools.wraps(run)
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim is not None:
                trim(0)

    return whole


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table (a file or a folder of part files), whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.  It cuts the lineage: what
    follows survives lost executors without computing ``df`` again."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    """The text column, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def rest_of(doc_id: Column, mod: int) -> Column:
    """crc32(doc_id as text) mod ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def sampled(df: DataFrame, bound: int, *cols: str) -> DataFrame:
    """About ``bound`` rows of ``df``, chosen by a hash of ``cols``, the same on every run; never
    more than twice that.  For fitting models: what they are applied to is never sampled."""
    share = min(1.0, bound / max(1, df.count()))
    return df.filter(F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * bound)
