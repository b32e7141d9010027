"""Accepted and refused records as two stored tables that change together.

A batch of raw records is split by a contract into a part of the accepted table and a part of the
refused one (raw text and every violation).  Later, refused records are checked against a newer
contract: those it accepts move, the others stay refused with their new violations.  Parts are
written first, under names of their own; one commit then makes both tables' new parts live and
drops the ones they replace, so a record is always in exactly one table.  A batch or a replay that
is repeated after a crash writes again and commits once; one that was committed changes nothing.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import contracts
from tidemark.operators.schemas import Contract
from tidemark.sources.commits import CommitLog


class SplitStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/commits")

    def state(self) -> tuple[int, dict]:
        number = self.log.latest()
        return number, json.loads(self.log.read(number)) if number else {"done": [], "accepted": [], "refused": []}

    def _split(self, step: str, rows: DataFrame, value: str, contract: Contract, replaces: list[str]) -> bool:
        """Write both parts of ``rows`` and commit them as ``step``; refused parts named in
        ``replaces`` go.  False where the step was committed before."""
        part = uuid.uuid4().hex
        checked = contracts.validate(rows, value, contract).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            contracts.accepted(checked, contract).write.parquet(f"{self.path}/accepted/{part}")
            contracts.quarantined(checked).write.parquet(f"{self.path}/refused/{part}")
        finally:
            checked.unpersist()
        while True:
            number, state = self.state()
            if step in state["done"] or not set(replaces) <= set(state["refused"]):
                return False  # done before, or another replay has taken these parts
            state["done"].append(step)
            state["accepted"].append({"part": part, "contract": contract.schema_json})
            state["refused"] = [p for p in state["refused"] if p not in replaces] + [part]
            if self.log.put(number + 1, json.dumps(state)):
                return True

    def ingest(self, batch: str, records: DataFrame, value: str, contract: Contract) -> bool:
        """Split a batch of records; False where a batch of that name is there already."""
        step = f"batch {batch}"
        return step not in self.state()[1]["done"] and self._split(step, records, value, contract, [])

    def replay(self, name: str, value: str, contract: Contract) -> bool:
        """Check all refused records against ``contract``; False where this replay is done."""
        step, state = f"replay {name}", self.state()[1]
        if step in state["done"] or not state["refused"]:
            return False
        return self._split(step, self._refused(state).drop("violations"), value, contract, state["refused"])

    def _refused(self, state: dict) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/refused/{p}" for p in state["refused"]])

    def refused(self) -> DataFrame:
        """Refused records with their violations under the last contract they were checked by."""
        return self._refused(self.state()[1])

    def accepted(self, target: Contract) -> DataFrame:
        """Accepted records as rows of ``target``, whichever contract accepted them: parts of one
        contract are one read."""
        by: dict[str, list[str]] = {}
        for p in self.state()[1]["accepted"]:
            by.setdefault(p["contract"], []).append(f"{self.path}/accepted/{p['part']}")
        if not by:
            return self.spark.createDataFrame([], target.spark_schema())
        reads = [contracts.conform(self.spark.read.schema(Contract.parse(c).spark_schema()).parquet(*paths), target)
                 for c, paths in sorted(by.items())]
        return reduce(DataFrame.unionByName, reads)
