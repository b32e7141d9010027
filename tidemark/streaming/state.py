"""Figures of a stream's state, read from its checkpoint with Spark's state data source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(operatorId, operatorName, stateStoreName, numPartitions, ...): the stateful operators."""
    return spark.read.format("state-metadata").load(checkpoint)


def state(spark: SparkSession, checkpoint: str, operator: int = 0, **options) -> DataFrame:
    """(key, value, partition_id) of one operator's state after the last committed batch."""
    return spark.read.format("statestore").option("operatorId", operator).options(**options).load(checkpoint)


def state_figures(spark: SparkSession, checkpoint: str, operator: int = 0, **options) -> DataFrame:
    """(partition_id, keys, share) of every state partition that holds keys; share 1 is even: keys
    over the mean of all partitions, empty ones included."""
    meta = operators(spark, checkpoint).where(F.col("operatorId") == operator)
    parts = meta.select(F.max("numPartitions")).scalar()
    held = state(spark, checkpoint, operator, **options).groupBy("partition_id").agg(F.count(F.lit(1)).alias("keys"))
    mean = held.select(F.sum("keys")).scalar() / parts
    return held.withColumn("share", F.col("keys") / mean)
