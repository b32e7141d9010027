"""Avro bodies of framed records, encoded and decoded as column jobs.

The spark-avro package (``to_avro``/``from_avro``) is not part of the Spark
distribution; this module needs no package: a small Arrow-batched codec runs
in ``mapInArrow`` over flat records of string, bytes, double, float, long, int,
boolean and unions with null.  Decoding makes one pass over the log: each
row's writer schema is found by its schema id, and the record is resolved to
the reader contract (reader fields the writer lacks take their defaults;
writer fields the reader lacks are skipped).  Rows with an unknown id or an
undecodable body keep their place with a ``problem``.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import DataFrame

from tidemark.operators.schemas import Contract


def _zigzag(n: int) -> int:
    return (n << 1) ^ (n >> 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n & ~0x7F:
        out.append((n & 0x7F) | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _put(avro_type: str, v) -> bytes:
    if avro_type == "string":
        b = v.encode("utf-8")
        return _varint(_zigzag(len(b))) + b
    if avro_type == "bytes":
        return _varint(_zigzag(len(v))) + bytes(v)
    if avro_type == "double":
        return struct.pack("<d", v)
    if avro_type == "float":
        return struct.pack("<f", v)
    if avro_type in ("long", "int"):
        return _varint(_zigzag(int(v)))
    if avro_type == "boolean":
        return b"\x01" if v else b"\x00"
    raise ValueError(avro_type)


def encode_record(contract: Contract, rec: dict) -> bytes:
    out = bytearray()
    for f in contract.fields:
        v = rec.get(f.name)
        if len(f.types) > 1:
            if v is None:
                out += _varint(_zigzag(f.types.index("null")))
                continue
            out += _varint(_zigzag(f.types.index(f.value_type)))
        elif v is None:
            raise ValueError(f"missing:{f.name}")
        out += _put(f.value_type, v)
    return bytes(out)


class _Reader:
    def __init__(self, buf: bytes):
        self.buf, self.pos = buf, 0

    def varint(self) -> int:
        shift = n = 0
        while True:
            b = self.buf[self.pos]
            self.pos += 1
            n |= (b & 0x7F) << shift
            if not b & 0x80:
                break
            shift += 7
        return (n >> 1) ^ -(n & 1)

    def take(self, n: int) -> bytes:
        if n < 0 or self.pos + n > len(self.buf):
            raise ValueError("truncated")
        b = self.buf[self.pos:self.pos + n]
        self.pos += n
        return b

    def read(self, avro_type: str):
        if avro_type == "null":
            return None
        if avro_type == "string":
            return self.take(self.varint()).decode("utf-8")
        if avro_type == "bytes":
            return self.take(self.varint())
        if avro_type == "double":
            return struct.unpack("<d", self.take(8))[0]
        if avro_type == "float":
            return struct.unpack("<f", self.take(4))[0]
        if avro_type in ("long", "int"):
            n = self.varint()
            bits = 63 if avro_type == "long" else 31
            if not -1 << bits <= n < 1 << bits:
                raise ValueError(f"{avro_type} out of range")
            return n
        if avro_type == "boolean":
            return self.take(1) != b"\x00"
        raise ValueError(avro_type)


def decode_record(writer: Contract, body: bytes) -> dict:
    r = _Reader(body)
    rec = {}
    for f in writer.fields:
        branch = r.varint() if len(f.types) > 1 else 0
        if not 0 <= branch < len(f.types):
            raise ValueError("no such branch")
        t = f.types[branch] if len(f.types) > 1 else f.value_type
        rec[f.name] = r.read(t)
    if r.pos != len(body):
        raise ValueError("trailing bytes")
    return rec


def _resolve(reader: Contract, writer: Contract, rec: dict) -> dict:
    out = {}
    for f in reader.fields:
        if writer.field(f.name) is not None:
            out[f.name] = rec[f.name]
        else:
            out[f.name] = f.default if f.has_default else None
    return out


def encode_bodies(df: DataFrame, contract: Contract, out_col: str = "body",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Avro body of each row's contract fields; rows that cannot be encoded
    get a null body and a ``problem``."""
    names = [f.name for f in contract.fields]
    schema = df.select(*keep).schema.simpleString()[7:-1]
    out_schema = ", ".join(x for x in (schema, f"{out_col} binary, problem string") if x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = b.to_pydict()
            bodies, problems = [], []
            for i in range(b.num_rows):
                try:
                    bodies.append(encode_record(contract, {n: cols[n][i] for n in names}))
                    problems.append(None)
                except (ValueError, TypeError, AttributeError, struct.error) as e:
                    bodies.append(None)
                    problems.append(str(e) or type(e).__name__)
            arrays = [b.column(k) for k in keep] + [pa.array(bodies, pa.binary()),
                                                   pa.array(problems, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, out_col, "problem"])

    return df.select(*keep, *[c for c in names if c not in keep]).mapInArrow(run, out_schema)


def decode_bodies(df: DataFrame, writers: dict[int, str], reader: Contract,
                  id_col: str = "schema_id", body_col: str = "body",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Decode Avro bodies written with the contract registered under each
    row's schema id, as rows of the ``reader`` contract (one pass)."""
    parsed = {int(k): Contract.parse(v) for k, v in writers.items()}
    names = [f.name for f in reader.fields]
    keep_schema = df.select(*keep).schema.simpleString()[7:-1]
    fields = reader.spark_schema().simpleString()[7:-1]
    out_schema = ", ".join(x for x in (keep_schema, fields, "problem string") if x)
    arrow_type = {"string": pa.string(), "bytes": pa.binary(), "double": pa.float64(),
                  "float": pa.float32(), "long": pa.int64(), "int": pa.int32(),
                  "boolean": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(id_col).to_pylist()
            bodies = b.column(body_col).to_pylist()
            values = {n: [] for n in names}
            problems = []
            for sid, body in zip(ids, bodies):
                rec, problem = None, None
                w = parsed.get(sid)
                if w is None:
                    problem = f"unknown_schema_id:{sid}"
                elif body is None:
                    problem = "missing_body"
                else:
                    try:
                        rec = _resolve(reader, w, decode_record(w, body))
                    except (ValueError, IndexError, UnicodeDecodeError, struct.error) as e:
                        problem = f"undecodable:{e}"
                for n in names:
                    values[n].append(None if rec is None else rec[n])
                problems.append(problem)
            arrays = [b.column(k) for k in keep]
            arrays += [pa.array(values[f.name], arrow_type[f.value_type]) for f in reader.fields]
            arrays.append(pa.array(problems, pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *names, "problem"])

    cols = list(dict.fromkeys([*keep, id_col, body_col]))
    return df.select(*cols).mapInArrow(run, out_schema)


def framed_records(validated: DataFrame, contract: Contract, schema_id: int,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """The framed binary sink's input: accepted records of ``contract`` as
    Avro bodies framed with ``schema_id`` (``value`` binary); records with
    violations are not framed and carry their reasons instead (``value`` is
    null), so the job never fails on a bad row."""
    from tidemark.functions.codec import frame
    from tidemark.operators.contracts import typed_fields

    ok = validated.where(F.size("violations") == 0).select(
        *keep, *typed_fields(F.col("_record"), contract))
    enc = encode_bodies(ok, contract, keep=keep)
    good = enc.select(*keep, F.when(F.col("body").isNotNull(),
                                    frame(F.lit(schema_id), "body")).alias("value"),
                      F.when(F.col("problem").isNotNull(), F.array("problem"))
                      .otherwise(F.array().cast("array<string>")).alias("violations"))
    bad = validated.where(F.size("violations") > 0).select(
        *keep, F.lit(None).cast("binary").alias("value"), "violations")
    return good.unionByName(bad)
