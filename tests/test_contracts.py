import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import contracts, schemas

V1 = schemas.Contract.parse(schemas.RIDE_V1)
GOOD = {"ride_id": "abc-123", "rider_name": "Test Rider", "pickup_city": "Columbus",
        "dropoff_city": "Cleveland", "fare": 42.5, "status": "completed",
        "event_time": "2026-09-23T12:00:00+00:00"}


def _with(**kw):
    d = dict(GOOD)
    for k, v in kw.items():
        if v is ...:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


CASES = [
    (json.dumps(GOOD), []),
    (_with(ride_id="def-456", fare="forty two dollars", status=...,
           event_time="2026-09-23T12:05:00+00:00"), ["type:fare", "missing:status"]),
    (_with(fare="4.5"), ["type:fare"]),
    (_with(fare=5), []),
    (_with(ride_id=12), ["type:ride_id"]),
    (_with(status=None), ["missing:status"]),
    (_with(event_time="nope"), []),
    (_with(extra_field=1), []),
    ("junk", ["malformed"]),
    ("[1, 2]", ["malformed"]),
]


def test_validate_exact_cases(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, value string")
    got = {r.i: list(r.violations) for r in
           contracts.validate(df, "value", V1).select("i", "violations").collect()}
    for i, (_, expected) in enumerate(CASES):
        assert got[i] == expected, CASES[i][0]


def test_accept_quarantine_split_and_summary(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, value string")
    v = contracts.validate(df, "value", V1)
    ok = contracts.accepted(v, V1, keep=("i",))
    bad = contracts.quarantined(v, keep=("i",))
    assert ok.count() + bad.count() == len(CASES)
    assert sorted(r.i for r in ok.collect()) == [0, 3, 6, 7]
    fares = {r.i: r.fare for r in ok.collect()}
    assert fares[3] == 5.0 and fares[0] == 42.5
    assert "value" in bad.columns and "violations" in bad.columns
    summ = {(r.field, r.kind): r.n for r in contracts.summary(v).collect()}
    assert summ == {("fare", "type"): 2, ("status", "missing"): 2, ("ride_id", "type"): 1,
                    ("", "malformed"): 2}


def test_nullable_union_field(spark):
    v2 = schemas.Contract.parse(schemas.RIDE_V2_SAFE)
    df = spark.createDataFrame([(json.dumps({**GOOD, "driver_rating": None}),),
                                (json.dumps(GOOD),),
                                (json.dumps({**GOOD, "driver_rating": "high"}),)], "value string")
    got = [list(r.violations) for r in contracts.validate(df, "value", v2).collect()]
    assert got == [[], [], ["type:driver_rating"]]


def test_compatibility_matrix():
    writer = schemas.Contract.parse(schemas.RIDE_V1)
    expect = {schemas.RIDE_V1: True, schemas.RIDE_V2_SAFE: True,
              schemas.RIDE_V2_BREAKING: False, schemas.RIDE_V2_REMOVED: True}
    for js, ok in expect.items():
        assert (not schemas.read_compatible(schemas.Contract.parse(js), writer)) == ok


def test_compatibility_agrees_with_avro_jar(spark):
    jvm = spark.sparkContext._jvm
    try:
        parser_cls = jvm.org.apache.avro.Schema.Parser
        compat = jvm.org.apache.avro.SchemaCompatibility
        parser_cls()
    except Exception:  # noqa: BLE001
        pytest.skip("Avro core classes not on the classpath")
    writer = parser_cls().parse(schemas.RIDE_V1)
    for js in (schemas.RIDE_V1, schemas.RIDE_V2_SAFE, schemas.RIDE_V2_BREAKING,
               schemas.RIDE_V2_REMOVED):
        reader = parser_cls().parse(js)
        jres = compat.checkReaderWriterCompatibility(reader, writer).getType().toString()
        ours = not schemas.read_compatible(schemas.Contract.parse(js),
                                           schemas.Contract.parse(schemas.RIDE_V1))
        assert (jres == "COMPATIBLE") == ours, js


def test_registry_register_latest(spark):
    rows, out = schemas.register([], "s", schemas.RIDE_V1)
    assert out == {"status": "registered", "version": 1, "schema_id": 1}
    rows, out = schemas.register(rows, "s", schemas.RIDE_V1)
    assert out["status"] == "exists" and len(rows) == 1
    rows, out = schemas.register(rows, "s", schemas.RIDE_V2_BREAKING)
    assert out["status"] == "incompatible" and len(rows) == 1
    rows, out = schemas.register(rows, "s", schemas.RIDE_V2_SAFE)
    assert out == {"status": "registered", "version": 2, "schema_id": 2}
    rows, out = schemas.register(rows, "t", schemas.RIDE_V1)
    assert out == {"status": "registered", "version": 1, "schema_id": 3}
    lat = {r.subject: (r.version, r.schema_id) for r in
           schemas.latest(schemas.registry_frame(spark, rows)).collect()}
    assert lat == {"s": (2, 2), "t": (1, 3)}


def test_evolve_union_defaults(spark):
    v2 = schemas.Contract.parse(schemas.RIDE_V2_SAFE)
    old = spark.createDataFrame([("a", "n", "c", "d", 1.0, "s", "t")],
                                "ride_id string, rider_name string, pickup_city string, "
                                "dropoff_city string, fare double, status string, event_time string")
    new = old.withColumn("ride_id", F.lit("b")).withColumn("driver_rating", F.lit(4.5))
    got = {r.ride_id: r.driver_rating for r in contracts.evolve_union([old, new], v2).collect()}
    assert got == {"a": None, "b": 4.5}
    with pytest.raises(ValueError):
        contracts.conform(old, schemas.Contract.parse(schemas.RIDE_V2_BREAKING))


def test_observed_schema_compat(spark):
    df = spark.createDataFrame([(json.dumps(GOOD),), (json.dumps({**GOOD, "fare": 3}),)],
                               "value string")
    got = {r.candidate: (r.compatible, list(r.problems)) for r in
           contracts.compat_with_observed(df, "value", {
               "v1": schemas.RIDE_V1, "v2_breaking": schemas.RIDE_V2_BREAKING,
               "v2_safe": schemas.RIDE_V2_SAFE}).collect()}
    assert got == {"v1": (True, []), "v2_safe": (True, []),
                   "v2_breaking": (False, ["missing:payment_method"])}


def test_compat_three_outcomes(spark):
    t = schemas.compat_table(spark, "s", schemas.RIDE_V1, {
        "safe": schemas.RIDE_V2_SAFE, "breaking": schemas.RIDE_V2_BREAKING,
        "broken": '{"type": "record", "name": "x", "fields": [{"name": "a", "type": "map"}]}',
        "not_json": "{"})
    got = {r.candidate: r.status for r in t.collect()}
    assert got == {"safe": "compatible", "breaking": "incompatible", "broken": "error",
                   "not_json": "error"}
