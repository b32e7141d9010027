"""Versioned record contracts: definitions, Spark schemas, compatibility and a
registry kept as a small table (subject, version, schema_id, schema_json).

Contracts are Avro record schemas.  Compatibility is the registry's default
rule, "new code must be able to read old data": the candidate (reader) must
read records written with the latest registered version (writer).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The ride contract versions (Avro record JSON).
RIDE_V1 = """{"type": "record", "name": "RideEvent", "namespace": "com.streamingplatform.rides",
 "fields": [
  {"name": "ride_id", "type": "string"},
  {"name": "rider_name", "type": "string"},
  {"name": "pickup_city", "type": "string"},
  {"name": "dropoff_city", "type": "string"},
  {"name": "fare", "type": "double"},
  {"name": "status", "type": "string"},
  {"name": "event_time", "type": "string"}]}"""

RIDE_V2_SAFE = """{"type": "record", "name": "RideEvent", "namespace": "com.streamingplatform.rides",
 "fields": [
  {"name": "ride_id", "type": "string"},
  {"name": "rider_name", "type": "string"},
  {"name": "pickup_city", "type": "string"},
  {"name": "dropoff_city", "type": "string"},
  {"name": "fare", "type": "double"},
  {"name": "status", "type": "string"},
  {"name": "event_time", "type": "string"},
  {"name": "driver_rating", "type": ["null", "double"], "default": null}]}"""

RIDE_V2_BREAKING = """{"type": "record", "name": "RideEvent", "namespace": "com.streamingplatform.rides",
 "fields": [
  {"name": "ride_id", "type": "string"},
  {"name": "rider_name", "type": "string"},
  {"name": "pickup_city", "type": "string"},
  {"name": "dropoff_city", "type": "string"},
  {"name": "fare", "type": "double"},
  {"name": "status", "type": "string"},
  {"name": "event_time", "type": "string"},
  {"name": "payment_method", "type": "string"}]}"""

# Ours: a field removed (the rule "removing a field is safe" needs a case).
RIDE_V2_REMOVED = """{"type": "record", "name": "RideEvent", "namespace": "com.streamingplatform.rides",
 "fields": [
  {"name": "ride_id", "type": "string"},
  {"name": "rider_name", "type": "string"},
  {"name": "pickup_city", "type": "string"},
  {"name": "fare", "type": "double"},
  {"name": "status", "type": "string"},
  {"name": "event_time", "type": "string"}]}"""

# Ours: a status that may be missing (records refused for it fit a later version).
RIDE_V2_STATUS = RIDE_V1.replace('"name": "status", "type": "string"', '"name": "status", "type": ["null", "string"], "default": null')

RIDE_SUBJECT = "rides_avro-value"

_PRIMITIVE = {
    "string": T.StringType(), "double": T.DoubleType(), "float": T.FloatType(),
    "long": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(),
    "bytes": T.BinaryType(),
}
# Avro type promotions a reader accepts (writer type -> reader types).
_PROMOTE = {
    "int": {"int", "long", "float", "double"},
    "long": {"long", "float", "double"},
    "float": {"float", "double"},
    "double": {"double"},
    "string": {"string", "bytes"},
    "bytes": {"bytes", "string"},
    "boolean": {"boolean"},
    "null": {"null"},
}
_NO_DEFAULT = object()


@dataclass(frozen=True)
class Field:
    name: str
    types: tuple[str, ...]          # one primitive, or the branches of a union
    default: object = _NO_DEFAULT

    @property
    def nullable(self) -> bool:
        return "null" in self.types

    @property
    def value_type(self) -> str:
        return next(t for t in self.types if t != "null") if self.types != ("null",) else "null"

    @property
    def has_default(self) -> bool:
        return self.default is not _NO_DEFAULT

    @property
    def default_value(self) -> object:
        """The default, null where there is none or it is null."""
        return self.default if self.has_default else None

    @property
    def required(self) -> bool:
        return not self.nullable


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    schema_json: str

    @staticmethod
    def parse(schema_json: str) -> "Contract":
        doc = json.loads(schema_json)
        if doc.get("type") != "record":
            raise ValueError("a contract is an Avro record")
        fields = []
        for f in doc["fields"]:
            t = f["type"]
            types = tuple(t) if isinstance(t, list) else (t,)
            for x in types:
                if x not in _PRIMITIVE and x != "null":
                    raise ValueError(f"unsupported type {x!r} for field {f['name']!r}")
            fields.append(Field(f["name"], types, f.get("default", _NO_DEFAULT)))
        name = ".".join(p for p in (doc.get("namespace"), doc["name"]) if p)
        return Contract(name, tuple(fields), canonical(schema_json))

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Contract":
        """A contract from a file holding one Avro record schema, on any file
        system that Spark reads."""
        return Contract.parse(spark.read.text(path, wholetext=True).first()[0])

    def field(self, name: str) -> Field | None:
        return next((f for f in self.fields if f.name == name), None)

    def spark_schema(self) -> T.StructType:
        return T.StructType([
            T.StructField(f.name, _PRIMITIVE[f.value_type], f.nullable) for f in self.fields])


def canonical(schema_json: str) -> str:
    """Compact JSON text with sorted keys: equal contracts compare equal."""
    return json.dumps(json.loads(schema_json), sort_keys=True, separators=(",", ":"))


def read_compatible(reader: Contract, writer: Contract) -> list[str]:
    """Problems a reader with ``reader`` has reading data written with
    ``writer`` (empty list = compatible).  Writer fields the reader lacks are
    skipped; reader fields the writer lacks need a default."""
    problems = []
    for rf in reader.fields:
        wf = writer.field(rf.name)
        if wf is None:
            if not rf.has_default:
                problems.append(f"reader field '{rf.name}' has no default and is missing in writer")
            continue
        for wt in wf.types:
            if not any(rt in _PROMOTE[wt] for rt in rf.types):
                problems.append(f"field '{rf.name}': writer type {wt} not readable as "
                                f"{'|'.join(rf.types)}")
    return problems


def compat_status(reader_json: str, writer_json: str) -> tuple[str, list[str]]:
    """('compatible' | 'incompatible' | 'error', problems).  A candidate that
    is not a valid contract is an error, never reported as incompatible."""
    try:
        reader, writer = Contract.parse(reader_json), Contract.parse(writer_json)
    except (ValueError, KeyError, TypeError) as e:
        return "error", [f"{type(e).__name__}: {e}"]
    problems = read_compatible(reader, writer)
    return ("incompatible" if problems else "compatible"), problems


def compat_table(spark: SparkSession, subject: str, writer_json: str,
                 candidates: dict[str, str]) -> DataFrame:
    """One row per candidate: (subject, candidate, status, problems)."""
    rows = [(subject, name, *compat_status(js, writer_json)) for name, js in candidates.items()]
    return spark.createDataFrame(
        rows, "subject string, candidate string, status string, problems array<string>")


# --- registry table ----------------------------------------------------------
#
# The registry is a catalogue: a few rows per subject.  Its rules run on those
# rows on the driver; ``registry_frame`` turns them into a table for joins.

REGISTRY_SCHEMA = "subject string, version int, schema_id bigint, schema_json string"
Row = tuple  # (subject, version, schema_id, schema_json)


def registry_frame(spark: SparkSession, rows: list[Row]) -> DataFrame:
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def latest(registry: DataFrame) -> DataFrame:
    """Latest version per subject: (subject, version, schema_id, schema_json)."""
    best = F.max_by(F.struct("schema_id", "schema_json"), "version")
    return registry.groupBy("subject").agg(F.max("version").alias("version"), best.alias("b")) \
        .select("subject", "version", "b.schema_id", "b.schema_json")


def check_registered(rows: list[Row], subject: str, schema_json: str) -> tuple[str, list[str]]:
    """Whether a candidate can read what the latest registered version of a
    subject has written: compat_status, or ('nothing_registered', [])."""
    mine = [r for r in rows if r[0] == subject]
    if not mine:
        return "nothing_registered", []
    return compat_status(schema_json, max(mine, key=lambda r: r[1])[3])


def register(rows: list[Row], subject: str, schema_json: str) -> tuple[list[Row], dict]:
    """Register a version; returns (new rows, outcome).

    Equal canonical text under the subject -> existing id (idempotent).
    Else the candidate must read data of the latest version; if not, the
    registry is unchanged and the outcome says why.  New ids are global.
    """
    text = canonical(schema_json)
    cand = Contract.parse(schema_json)
    mine = [r for r in rows if r[0] == subject]
    for r in mine:
        if r[3] == text:
            return rows, {"status": "exists", "version": r[1], "schema_id": r[2]}
    if mine:
        cur = max(mine, key=lambda r: r[1])
        problems = read_compatible(cand, Contract.parse(cur[3]))
        if problems:
            return rows, {"status": "incompatible", "problems": problems}
    new_id = max((r[2] for r in rows), default=0) + 1
    version = max((r[1] for r in mine), default=0) + 1
    return rows + [(subject, version, new_id, text)], {
        "status": "registered", "version": version, "schema_id": new_id}
