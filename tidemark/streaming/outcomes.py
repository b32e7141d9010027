"""Bounded keyed dedup on a stream that loses no row: each gets an outcome.

``dropDuplicatesWithinWatermark`` drops a row that is older than the watermark when it arrives,
new or not, and only counts it.  Here every row comes out once, as

* ``accepted``: the first of its key, or the first since the key was forgotten,
* ``duplicate``: its key is known,
* ``late``: older than the watermark; whether its key was seen can't be told any more,
* ``untimed``: it has no event time.

A key is known until the watermark reaches its accepted event time plus a horizon; a timer then
frees its state, so state is bounded by the keys of one horizon.  The watermark of a micro-batch
comes from the batches before it.  Of a key's rows in one batch the earliest is accepted, ties by
the other columns' text: what is accepted doesn't depend on how tasks cut the batch.

Equal rows are one with a count before they are shuffled (``copies``), so a record that is sent
again and again costs a row a task.  Sums of ``copies`` over outcomes are the rows that came in.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# the processor is shipped by value: executors may have no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ACCEPTED, DUPLICATE, LATE, UNTIMED = "accepted", "duplicate", "late", "untimed"
TIME, COPIES, OUTCOME = "event_us", "copies", "outcome"


def told(row: Row, outcome: str, copies: int | None = None) -> Row:
    return Row(**row.asDict() | {COPIES: copies or row[COPIES], OUTCOME: outcome})


class KnownKeys(StatefulProcessor):
    """State of a key: the event time (microseconds) at which it was accepted.  A key's rows of a
    batch pass by one at a time; one of them is held."""

    def __init__(self, horizon_us: int):
        self.horizon_us = horizon_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.accepted = handle.getValueState("accepted", "us long")

    def handleInputRows(self, key, rows, timerValues):
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        since = self.accepted.get()[0] if self.accepted.exists() else None
        if since is not None and mark >= since + self.horizon_us:
            self.handle.deleteTimer((since + self.horizon_us + 999) // 1000)  # due in this batch
            since = None
        best = None  # the row to accept, so far
        for row in rows:
            us = row[TIME]
            if us is None or us < mark:
                yield told(row, UNTIMED if us is None else LATE)
            elif since is not None:
                yield told(row, DUPLICATE)
            elif best is None or (us, *map(str, row)) < (best[TIME], *map(str, best)):
                if best is not None:
                    yield told(best, DUPLICATE)
                best = row
            else:
                yield told(row, DUPLICATE)
        if best is not None:
            self.accepted.update((best[TIME],))
            self.handle.registerTimer((best[TIME] + self.horizon_us + 999) // 1000)
            yield told(best, ACCEPTED, 1)
            if best[COPIES] > 1:
                yield told(best, DUPLICATE, best[COPIES] - 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.accepted.clear()
        return iter([])

    def close(self) -> None:
        pass


def dedup_outcomes(stream: DataFrame, keys: Sequence[str], ts: str, delay: str, horizon_seconds: int) -> DataFrame:
    """The columns of ``stream``, copies and outcome.  Needs the RocksDB state store
    (``build_session`` sets it, ``with_rocksdb`` makes a session that has it).  A null key is a key."""
    names, keys = stream.columns, list(keys)
    # the watermark is kept on ts; the operator sees the time as a number, so Spark drops nothing
    marked = stream.withWatermark(ts, delay).withColumn(TIME, F.unix_micros(ts))
    carried = [n for n in names if n not in keys and n != ts]
    plain = marked.select(*keys, F.col(TIME), *carried)

    def combined(batches):
        for batch in batches:
            equal = pa.Table.from_batches([batch]).group_by(batch.schema.names).aggregate([([], "count_all")])
            yield from equal.rename_columns([*batch.schema.names, COPIES]).to_batches()

    fields = ", ".join(f"`{c}` {plain.schema[c].dataType.simpleString()}" for c in plain.columns)
    counted = plain.mapInArrow(combined, f"{fields}, {COPIES} long")
    out = counted.groupBy(*keys).transformWithState(
        KnownKeys(horizon_seconds * 1_000_000), f"{fields}, {COPIES} long, {OUTCOME} string", "Append", "EventTime")
    return out.withColumn(ts, F.timestamp_micros(TIME)).select(*names, COPIES, OUTCOME)
