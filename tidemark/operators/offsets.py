"""Dense per-partition offsets, as a log broker assigns them.

A window ``row_number() OVER (PARTITION BY part ORDER BY ...)`` would put a
whole log partition into one task.  Instead rows are cut into blocks of a
coarse, order-preserving bucket; block sizes are counted (partial
aggregation, one small row per block), turned into block start offsets by a
running sum over that small table, and each row's offset is its block start
plus its rank inside the block.  No task ever holds more than one block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BLK = "_tm_blk"
_START = "_tm_start"
_PART, _AT = "_tm_part", "_tm_at"


def block_counts(df: DataFrame, partition_col: str, block: Column) -> DataFrame:
    """Rows of each block of a partition: one small row per block."""
    return df.withColumn(_BLK, block).groupBy(partition_col, _BLK).agg(F.count(F.lit(1)).alias("_tm_n"))


def end_offsets(df: DataFrame, partition_col: str, block: Column) -> DataFrame:
    """(partition, end_offset) that ``assign_offsets`` will give: counts, no row is ranked.  They are
    the same block counts, so a plan that uses both makes them once."""
    counts = block_counts(df, partition_col, block)
    return counts.groupBy(partition_col).agg(F.sum("_tm_n").cast("bigint").alias("end_offset"))


def assign_offsets(df: DataFrame, partition_col: str, order_cols: Sequence[str],
                   block: Column, out_col: str = "off") -> DataFrame:
    """Add ``out_col`` = 0-based position of the row within its partition.

    ``block`` must be monotone in ``order_cols`` (every row of block b sorts
    before every row of block b+1 of the same partition); it bounds the
    number of rows any single task ranks.
    """
    d = df.withColumn(_BLK, block)
    counts = block_counts(df, partition_col, block)
    running = Window.partitionBy(partition_col).orderBy(_BLK).rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(partition_col).alias(_PART), F.col(_BLK).alias(_AT),
        F.coalesce(F.sum("_tm_n").over(running), F.lit(0)).cast("bigint").alias(_START))
    within = Window.partitionBy(partition_col, _BLK).orderBy(*order_cols)
    # null-safe: rows without a partition are a partition, rows without a block come first
    here = F.col(partition_col).eqNullSafe(F.col(_PART)) & F.col(_BLK).eqNullSafe(F.col(_AT))
    return (d.join(starts, here)
            .withColumn(out_col, F.col(_START) + F.row_number().over(within).cast("bigint") - 1)
            .drop(_BLK, _START, _PART, _AT))
