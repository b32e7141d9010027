"""Property tests: codecs round-trip on generated inputs."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import codec
from tidemark.operators import avro, schemas

MIXED = schemas.Contract.parse(
    '{"type": "record", "name": "m", "fields": ['
    '{"name": "s", "type": "string"}, {"name": "d", "type": "double"},'
    '{"name": "n", "type": "long"}, {"name": "b", "type": "boolean"},'
    '{"name": "o", "type": ["null", "double"], "default": null}]}')

records = st.fixed_dictionaries({
    "s": st.text(max_size=40),
    "d": st.floats(allow_nan=False),
    "n": st.integers(min_value=-(2**63), max_value=2**63 - 1),
    "b": st.booleans(),
    "o": st.none() | st.floats(allow_nan=False, allow_infinity=False),
})


@given(records)
@settings(max_examples=300)
def test_avro_record_roundtrip(rec):
    assert avro.decode_record(MIXED, avro.encode_record(MIXED, rec)) == rec


@given(st.lists(st.tuples(st.integers(0, 2**32 - 1), st.binary(max_size=30)), min_size=1,
                max_size=40))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_frame_roundtrip(spark, pairs):
    df = spark.createDataFrame(pairs, "sid bigint, body binary")
    out = df.select("sid", "body", codec.unframe(codec.frame("sid", "body")).alias("u")).collect()
    for r in out:
        assert (r.u.magic, r.u.schema_id, bytes(r.u.body), r.u.problem) == \
            (0, r.sid, bytes(r.body), None)


timestamps = st.datetimes(min_value=dt.datetime(1971, 1, 1), max_value=dt.datetime(2200, 1, 1))


@given(st.lists(timestamps, min_size=1, max_size=40))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_iso_text_roundtrip(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t timestamp_ntz") \
        .select(F.col("t").cast("timestamp").alias("t"))
    out = df.select(
        F.col("t").cast("timestamp_ntz").alias("t"),
        codec.iso_parse(codec.iso_format("t")).cast("timestamp_ntz").alias("ms"),
        codec.iso_parse(codec.iso_format_offset("t")).cast("timestamp_ntz").alias("us")).collect()
    for r in out:
        assert r.us == r.t
        assert r.ms == r.t.replace(microsecond=r.t.microsecond // 1000 * 1000)


def test_float_specials_roundtrip():
    for d in (math.inf, -math.inf, 0.0, -0.0, 5e-324):
        rec = {"s": "", "d": d, "n": 0, "b": False, "o": None}
        assert avro.decode_record(MIXED, avro.encode_record(MIXED, rec)) == rec


V2 = schemas.Contract.parse(schemas.RIDE_V2_SAFE)
json_values = st.one_of(st.none(), st.booleans(), st.integers(-10**6, 10**6),
                        st.floats(allow_nan=False, allow_infinity=False, width=32),
                        st.text(max_size=8), st.lists(st.integers(), max_size=2),
                        st.dictionaries(st.text(max_size=3), st.integers(), max_size=2))
field_states = st.fixed_dictionaries(
    {f.name: st.one_of(st.just("absent"), json_values) for f in V2.fields})


def _expected(rec: dict) -> list[str]:
    """The contract rules, stated plainly."""
    out = []
    for f in V2.fields:
        v = rec.get(f.name)
        if v is None:
            if not f.nullable:
                out.append(f"missing:{f.name}")
            continue
        if f.value_type == "string":
            ok = isinstance(v, str)
        else:  # double
            ok = isinstance(v, (int, float)) and not isinstance(v, bool)
        if not ok:
            out.append(f"type:{f.name}")
    return out


@given(st.lists(field_states, min_size=1, max_size=30))
@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_validation_matches_rules(spark, states):
    import json

    from tidemark.operators import contracts
    recs = [{k: v for k, v in s.items() if v != "absent"} for s in states]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(recs)],
                               "i int, value string")
    got = {r.i: list(r.violations) for r in
           contracts.validate(df, "value", V2).select("i", "violations").collect()}
    for i, r in enumerate(recs):
        assert got[i] == _expected(r), r


keys = st.lists(st.one_of(st.none(), st.sampled_from("aabbbbcdef")), min_size=1, max_size=60)


@given(keys, st.lists(st.one_of(st.none(), st.sampled_from("abcxyz")), max_size=10))
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_dedup_family_matches_brute_force(spark, ks, seen_keys):
    from tidemark.operators import delivery
    log = spark.createDataFrame([(k, i % 3, i) for i, k in enumerate(ks)],
                                "k string, part int, off bigint")
    order = sorted(range(len(ks)), key=lambda i: (i % 3, i))
    first = {}
    for i in order:
        first.setdefault(ks[i], i)
    got = {r.k: r.off for r in delivery.keep_first(log, "k", ["part", "off"]).collect()}
    assert got == first
    flags = {r.off: r.is_duplicate for r in
             delivery.flag_duplicates(log, "k", ["part", "off"]).collect()}
    assert flags == {i: first[ks[i]] != i for i in range(len(ks))}
    seen = spark.createDataFrame([(k,) for k in seen_keys], "k string")
    fresh = {r.k: r.off for r in
             delivery.dedup_against_seen(log, seen, "k", ["part", "off"]).collect()}
    assert fresh == {k: i for k, i in first.items() if k not in set(seen_keys)}
    a = delivery.duplicate_audit(log, "k").first()
    assert (a.processed, a.unique_rides, a.duplicates) == \
        (len(ks), len(set(ks)), len(ks) - len(set(ks)))


events = st.lists(st.tuples(st.integers(0, 120), st.integers(0, 6)), min_size=1, max_size=40)


@given(events, st.sampled_from([1, 2]))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_late_classification_matches_brute_force(spark, evs, lag):
    from tidemark.operators import eventtime
    t0 = dt.datetime(2026, 9, 23)
    df = spark.createDataFrame(
        [(i, t0 + dt.timedelta(seconds=s), b) for i, (s, b) in enumerate(evs)],
        "ride_id int, t timestamp_ntz, batch int") \
        .select("ride_id", F.col("t").cast("timestamp").alias("event_time"), "batch")
    batches = sorted({b for _, b in evs})
    bmax = {b: max(s for s, bb in evs if bb == b) for b in batches}
    wm = {}
    for j, b in enumerate(batches):
        prior = [bmax[x] for x in batches[:max(0, j - lag + 1)]]
        wm[b] = max(prior) - 5 if prior else None
    expect = {}
    for i, (s, b) in enumerate(evs):
        end = (s // 10 + 1) * 10
        expect[i] = wm[b] is not None and end <= wm[b]
    got = {r.ride_id: r.is_late for r in
           eventtime.late_classify(df, "event_time", "batch", "10 seconds", 5, lag).collect()}
    assert got == expect


@given(st.lists(st.tuples(st.integers(0, 500), st.integers(0, 3)), min_size=1, max_size=60,
                unique_by=lambda t: t[0]), st.integers(1, 50))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_offsets_match_row_number(spark, rows_, block):
    from tidemark.operators.offsets import assign_offsets
    df = spark.createDataFrame(rows_, "id bigint, part int")
    got = {r.id: r.off for r in
           assign_offsets(df, "part", ["id"], F.expr(f"id div {block}"), "off").collect()}
    expect = {}
    for p in {p for _, p in rows_}:
        for n, i in enumerate(sorted(i for i, pp in rows_ if pp == p)):
            expect[i] = n
    assert got == expect


@given(st.lists(st.tuples(st.integers(0, 3600), st.integers(0, 1000)), min_size=1, max_size=30,
                unique_by=lambda t: t[0]))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_counter_rate_matches_brute_force(spark, samples):
    from tidemark.operators import metrics
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("t", 0, t0 + dt.timedelta(seconds=s), float(v), "d")
                                for s, v in samples],
                               "topic string, part int, ts timestamp, value double, day string")
    got = metrics.counter_rate(df, ["topic", "part"], "ts", "value", "day").first().rate
    pts = sorted(samples)
    inc = sum((v if v < pv else v - pv) for (_, pv), (_, v) in zip(pts, pts[1:]))
    span = pts[-1][0] - pts[0][0]
    if span == 0:
        assert got is None
    else:
        assert math.isclose(got, inc / span, rel_tol=1e-12)
