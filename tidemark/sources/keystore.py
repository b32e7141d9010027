"""Saved keys in buckets, so that a run joins them without moving them.

Keys are kept with a hash of them that is never null, in segments of ``buckets`` files: file b holds
the keys whose hash falls in bucket b, sorted.  A run's new keys are one segment of level 0.  When
``fanout`` segments of a level are there, they are merged, bucket by bucket, into one of the next
level; so n runs are about ``fanout * log(n)`` segments.  Reading gives one bucketed table over the
live segments: a join on the hash takes each bucket as it lies, and only the other side is dealt.

Which segments are live stands in a commit log.  A run commits against the state it read; another
run's commit in between makes it fail, a merge in between doesn't.  The newest run may be repeated
(its segment is replaced); it is therefore never merged.  The list of runs grows by a name a run.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.commits import CommitLog

KEY, HASH = "_tm_key", "_tm_hash"


class RunConflict(Exception):
    """Another run committed keys after this one read them, or the run is long past."""


@dataclass
class KeyStore:
    """Keys of one type at ``path``.  ``buckets`` counts when the store is made and stays: choose it
    for the size the store will grow to (a bucket of a run's new keys is hashed in memory)."""

    spark: SparkSession
    path: str
    key_type: str = "string"
    buckets: int = 64
    fanout: int = 4

    def __post_init__(self):
        self.path = self.path.rstrip("/")
        self.log = CommitLog(self.spark, f"{self.path}/commits")
        state = {"buckets": self.buckets, "key_type": self.key_type, "runs": [], "segments": []}
        if not self.log.latest():
            self.log.put(1, json.dumps(state))
        state = self.state()[1]
        self.buckets, self.key_type = state["buckets"], state["key_type"]

    def state(self) -> tuple[int, dict]:
        number = self.log.latest()
        return number, json.loads(self.log.read(number))

    def _table(self, segments: list[dict]) -> DataFrame:
        """A bucketed table over segments.  Its entry in the session's catalogue holds places only;
        the same segments are the same entry."""
        names = sorted(s["name"] for s in segments)
        own = hashlib.md5(json.dumps([self.path, *names]).encode()).hexdigest()
        table = f"tidemark_keys_{own}"
        if not self.spark.catalog.tableExists(table):
            self.spark.sql(f"CREATE TABLE {table} ({KEY} {self.key_type}, {HASH} BIGINT, segment STRING) USING parquet "
                           f"PARTITIONED BY (segment) CLUSTERED BY ({HASH}) SORTED BY ({HASH}) INTO {self.buckets} BUCKETS "
                           f"LOCATION '{self.path}/segments'")
            places = " ".join(f"PARTITION (segment='{n}') LOCATION '{self.path}/segments/segment={n}'" for n in names)
            if places:
                self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {places}")
        return self.spark.table(table).select(KEY, HASH)

    def keys(self, without_run: str | None = None) -> DataFrame:
        """(KEY, HASH) of all live segments but those of ``without_run``, bucketed by HASH."""
        _, state = self.state()
        return self._table([s for s in state["segments"] if s["run"] is None or s["run"] != without_run])

    def _write(self, rows: DataFrame) -> str:
        """Rows that lie a bucket in a partition, as a segment."""
        name, table = uuid.uuid4().hex, f"tidemark_segment_{uuid.uuid4().hex}"
        rows.write.format("parquet").bucketBy(self.buckets, HASH).sortBy(HASH) \
            .option("path", f"{self.path}/segments/segment={name}").saveAsTable(table)
        self.spark.sql(f"DROP TABLE {table}")  # the files stay
        return name

    def check(self, run_id: str) -> None:
        """Whether a run of that name may start: a new one, or the newest again."""
        runs = self.state()[1]["runs"]
        if run_id in runs[:-1]:
            raise RunConflict(f"run {run_id} has been followed by {runs[-1]}; its keys can't be told apart any more")

    def commit(self, run_id: str, keys: DataFrame, read: int) -> None:
        """Save a run's new ``keys`` (one column; no key twice), taken against state ``read``."""
        runs = json.loads(self.log.read(read))["runs"]
        key = F.col(keys.columns[0])
        name = self._write(keys.select(key.alias(KEY), F.xxhash64(key).alias(HASH)).repartition(self.buckets, HASH))
        while True:
            number, state = self.state()
            if state["runs"] != runs:
                raise RunConflict(f"runs {state['runs'][len(runs):]} were committed while {run_id} ran")
            state["segments"] = [s for s in state["segments"] if s["run"] != run_id] + [{"name": name, "level": 0, "run": run_id}]
            state["runs"] = [r for r in runs if r != run_id] + [run_id]
            if self.log.put(number + 1, json.dumps(state)):
                return

    def merge(self) -> None:
        """Merge full levels, but never the newest run's segment.  Buckets are merged where they
        lie; only names are committed."""
        while True:
            number, state = self.state()
            closed = [s for s in state["segments"] if s["run"] is None or s["run"] != state["runs"][-1]]
            full = next((level for level in sorted({s["level"] for s in closed})
                         if sum(s["level"] == level for s in closed) >= self.fanout), None)
            if full is None:
                return
            some = [s["name"] for s in closed if s["level"] == full]
            merged = self._table([s for s in closed if s["level"] == full]).distinct()
            name = self._write(merged)
            state["segments"] = [s for s in state["segments"] if s["name"] not in some] + [{"name": name, "level": full + 1, "run": None}]
            self.log.put(number + 1, json.dumps(state))  # where another was first, look again

    def vacuum(self, keep: int = 2) -> int:
        """Delete segments that none of the last ``keep`` states names; returns how many.  Call it
        while no run is writing: a segment not yet committed is in no state."""
        number = self.log.latest()
        named = {s["name"] for n in range(max(1, number - keep + 1), number + 1) for s in json.loads(self.log.read(n))["segments"]}
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/segments")
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        gone = 0
        for st in fs.listStatus(root) if fs.exists(root) else []:
            name = st.getPath().getName()
            if name.startswith("segment=") and name[8:] not in named:
                gone += bool(fs.delete(st.getPath(), True))
        return gone


def not_in_store(first: DataFrame, key: str, seen: DataFrame) -> DataFrame:
    """Rows of ``first`` (no key twice) whose key ``seen`` (a store's table) lacks; null is a key.
    Only ``first`` is dealt, to the buckets, and hashed there; the saved keys stream by."""
    names = first.columns
    dealt = first.withColumn("_tm_own", F.xxhash64(key))
    # the hash alone is the join's key (a null-safe equality would be a second one, which buckets
    # don't follow); the keys themselves are compared on what meets
    nulls = F.col(key).isNull(), F.col(KEY).isNull()
    same = (F.col("_tm_own") == F.col(HASH)) & F.when(nulls[0] | nulls[1], nulls[0] & nulls[1]).otherwise(
        F.col(key) == F.col(KEY))
    return dealt.hint("shuffle_hash").join(seen, same, "left").where(F.col(HASH).isNull()).select(*names)
