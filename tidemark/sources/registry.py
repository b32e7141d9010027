"""A stored registry of contract versions: append-only, with rules, for several writers.

A registration is one commit of a ``CommitLog``; its number is the schema id.  A writer reads all
commits, applies the rules (``schemas.register``) and puts the next number; where another writer
was first, it reads again, so that two registrations get two ids, and of two equal ones the second
gets the id of the first.

    python -m tidemark.sources.registry check|register <registry folder> <subject> <contract file>
"""

from __future__ import annotations

import json
import sys

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import schemas
from tidemark.sources.commits import CommitLog

_FIELDS = ("subject", "version", "schema_id", "schema_json")


class Registry:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, self.path)
        self._rows: list[schemas.Row] = []

    def rows(self) -> list[schemas.Row]:
        """All registered versions, in order of id.  Commits never change: only new ones are read."""
        for number in range(len(self._rows) + 1, self.log.latest() + 1):
            doc = json.loads(self.log.read(number))
            self._rows.append(tuple(doc[f] for f in _FIELDS))
        return list(self._rows)

    def check(self, subject: str, schema_json: str) -> tuple[str, list[str]]:
        """Whether a contract can read what the subject's latest version has written."""
        return schemas.check_registered(self.rows(), subject, schema_json)

    def register(self, subject: str, schema_json: str) -> dict:
        """The outcome: registered or exists (version, schema_id), or incompatible (problems).
        A text that is no contract is an error and changes nothing."""
        while True:
            known = self.rows()
            after, outcome = schemas.register(known, subject, schema_json)
            if outcome["status"] != "registered":
                return outcome
            if self.log.put(outcome["schema_id"], json.dumps(dict(zip(_FIELDS, after[-1])))):
                return outcome

    def table(self) -> DataFrame:
        """(subject, version, schema_id, schema_json), read from the stored files by Spark."""
        if not self.log.latest():
            return self.spark.createDataFrame([], schemas.REGISTRY_SCHEMA)
        return self.spark.read.schema(schemas.REGISTRY_SCHEMA).option("pathGlobFilter", "*.json").json(self.path)


def main(argv: list[str], spark: SparkSession | None = None) -> int:
    """0 where the contract fits or is registered, 1 where it isn't, 2 for a wrong call."""
    if len(argv) != 4 or argv[0] not in ("check", "register"):
        print("usage: check|register <registry folder> <subject> <contract file>", file=sys.stderr)
        return 2
    from tidemark.session import build_session
    spark = spark or build_session(master="local[2]")
    registry, text = Registry(spark, argv[1]), schemas.Contract.load(spark, argv[3]).schema_json
    if argv[0] == "check":
        status, problems = registry.check(argv[2], text)
        outcome = {"status": status, "problems": problems}
    else:
        outcome = registry.register(argv[2], text)
    print(json.dumps(outcome))
    return int(outcome["status"] in ("incompatible", "error"))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
