"""Contract split on a stream: every micro-batch is validated once and
written to two tables, accepted (typed) and quarantined (raw value plus
every violation).

``foreachBatch`` is at-least-once: a micro-batch can run again after a
failure.  Each batch is therefore written into its own ``batch_id=<n>``
folder with overwrite, so a repeated batch replaces its own output and the
two tables stay exactly-once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators import contracts
from tidemark.operators.schemas import Contract
from tidemark.session import fresh_dir


@dataclass
class SplitRun:
    accepted_path: str
    quarantine_path: str
    query: StreamingQuery
    accepted_schema: StructType
    quarantine_schema: StructType


def split_stream(stream: DataFrame, value_col: str, contract: Contract,
                 keep: tuple[str, ...] = (), label: str = "contract-split",
                 checkpoint: str | None = None, accepted_path: str | None = None,
                 quarantine_path: str | None = None, trigger: dict | None = None,
                 wait: bool = True) -> SplitRun:
    spark = stream.sparkSession
    accepted_path = accepted_path or fresh_dir(spark, f"{label}-accepted")
    quarantine_path = quarantine_path or fresh_dir(spark, f"{label}-quarantine")
    checkpoint = checkpoint or fresh_dir(spark, f"{label}-ckpt")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        v = contracts.validate(batch, value_col, contract).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            contracts.accepted(v, contract, keep).write.mode("overwrite") \
                .parquet(f"{accepted_path}/batch_id={batch_id}")
            contracts.quarantined(v, keep).write.mode("overwrite") \
                .parquet(f"{quarantine_path}/batch_id={batch_id}")
        finally:
            v.unpersist()

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True}))
         .start())
    if wait:
        q.awaitTermination()
    like = contracts.validate(spark.createDataFrame([], stream.schema), value_col, contract)
    return SplitRun(accepted_path, quarantine_path, q,
                    contracts.accepted(like, contract, keep).schema,
                    contracts.quarantined(like, keep).schema)
