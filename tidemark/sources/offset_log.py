"""A log stored by (partition, offset), so that a scan from committed offsets skips what it need not read.

Files cover ranges of (partition, offset) and are sorted within; a filter on both columns then
skips whole files and row groups by their statistics, as a broker seeks to an offset.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a row group: what a scan reads or skips as one.
ROW_GROUP = 16 << 20


def store_log(df: DataFrame, path: str, part: str = "part", off: str = "off", row_group: int = ROW_GROUP) -> str:
    """Write ``df`` as a stored log; returns the path."""
    df.repartitionByRange(part, off).sortWithinPartitions(part, off).write \
        .option("parquet.block.size", row_group).parquet(path)
    return path


def from_offsets(committed: dict[int | None, int], part: str = "part", off: str = "off") -> Column:
    """Rows at or after the committed offset of their partition; partitions without a commit whole."""
    p, starts = F.col(part), sorted((k, v) for k, v in committed.items() if k is not None)
    known = [(p == k) & (F.col(off) >= v) for k, v in starts]
    if None in committed:
        known.append(p.isNull() & (F.col(off) >= committed[None]))
    else:
        known.append(p.isNull())
    if starts:
        known.append(~p.isin([k for k, _ in starts]))
    else:
        known.append(p.isNotNull())
    return reduce(lambda a, b: a | b, known)


def scan_from(spark: SparkSession, path: str, committed: DataFrame, part: str = "part", off: str = "off") -> DataFrame:
    """The stored log from the ``committed`` offsets (a row per partition: ``part``, committed; null
    is no commit).  These rows come to the driver, as starting offsets do: one per partition."""
    starts = {r[part]: r["committed"] for r in committed.select(part, "committed").collect() if r["committed"] is not None}
    return spark.read.parquet(path).where(from_offsets(starts, part, off))


def end_offsets(spark: SparkSession, path: str, part: str = "part") -> DataFrame:
    """(part, end_offset): offsets are dense, so a count per partition, of one column."""
    return spark.read.parquet(path).groupBy(part).agg(F.count(F.lit(1)).alias("end_offset"))
