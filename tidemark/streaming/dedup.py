"""Keyed dedup on streams.

``dedup`` keeps every key ever seen in the state store (use the RocksDB
provider: state lives on local disk of the executors and in the checkpoint,
not in memory).  ``dedup_bounded`` forgets a key once the watermark passes
its event time + delay, so state stays bounded; a key redelivered after that
is let through again.  A row older than the watermark when it arrives is
dropped even if its key is new; ``StreamRun.progress`` counts those rows
(``numRowsDroppedByWatermark`` of the state operator).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def dedup(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    return stream.dropDuplicates(list(keys))


def dedup_bounded(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
