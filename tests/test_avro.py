from pyspark.sql import functions as F

from tidemark.functions import codec
from tidemark.operators import avro, schemas

V1 = schemas.Contract.parse(schemas.RIDE_V1)
V2 = schemas.Contract.parse(schemas.RIDE_V2_SAFE)
REC = {"ride_id": "r1", "rider_name": "n", "pickup_city": "Toledo", "dropoff_city": "Ohio",
       "fare": 12.25, "status": "completed", "event_time": "2026-09-23T12:00:00.000Z"}


def test_record_roundtrip_and_known_bytes():
    body = avro.encode_record(V1, REC)
    # string "r1": zigzag(2) = 4, then the bytes
    assert body[:3] == b"\x04r1"
    assert avro.decode_record(V1, body) == REC
    b2 = avro.encode_record(V2, {**REC, "driver_rating": None})
    assert b2.endswith(b"\x00")  # union branch 0 = null
    assert avro.decode_record(V2, b2)["driver_rating"] is None
    assert avro.decode_record(V2, avro.encode_record(V2, {**REC, "driver_rating": 4.5}))[
        "driver_rating"] == 4.5


def test_varint_long_values():
    c = schemas.Contract.parse('{"type":"record","name":"x","fields":[{"name":"n","type":"long"}]}')
    for n in (0, -1, 63, -64, 64, 2**40, -(2**40)):
        assert avro.decode_record(c, avro.encode_record(c, {"n": n})) == {"n": n}


def test_column_jobs_route_resolve_and_problems(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, ride_id string, fare double")
    full = df
    for f in V1.fields:
        if f.name not in df.columns:
            full = full.withColumn(f.name, F.lit("x"))
    enc = avro.encode_bodies(full, V1, keep=("k",))
    framed = enc.select("k", codec.frame(F.when(F.col("k") == 1, 1).otherwise(9), "body")
                        .alias("value"))
    framed = framed.unionByName(spark.createDataFrame(
        [(3, bytes.fromhex("0000000001") + b"\x04")], "k int, value binary"))
    split = framed.select("k", codec.unframe("value").alias("u")).select("k", "u.schema_id",
                                                                       "u.body")
    out = {r.k: r for r in avro.decode_bodies(split, {1: schemas.RIDE_V1}, V2,
                                              keep=("k",)).collect()}
    assert out[1].ride_id == "a" and out[1].fare == 1.0 and out[1].driver_rating is None
    assert out[1].problem is None
    assert out[2].problem == "unknown_schema_id:9" and out[2].ride_id is None
    assert out[3].problem.startswith("undecodable")


def test_encode_rejects_missing_required(spark):
    df = spark.createDataFrame([("a",)], "ride_id string")
    for f in V1.fields[1:]:
        df = df.withColumn(f.name, F.lit(None).cast("double" if f.name == "fare" else "string"))
    r = avro.encode_bodies(df, V1).first()
    assert r.body is None and r.problem == "missing:rider_name"


def test_framed_records_from_json(spark):
    import json
    from tidemark.operators import contracts
    good = json.dumps(REC)
    bad = json.dumps({**REC, "fare": "forty two dollars"})
    df = spark.createDataFrame([(1, good), (2, bad), (3, "junk")], "k int, value string")
    out = {r.k: r for r in avro.framed_records(contracts.validate(df, "value", V1), V1, 7,
                                               keep=("k",)).collect()}
    assert bytes(out[1].value)[:5] == bytes.fromhex("0000000007")
    assert avro.decode_record(V1, bytes(out[1].value)[5:]) == REC
    assert out[2].value is None and list(out[2].violations) == ["type:fare"]
    assert list(out[3].violations) == ["malformed"]
