import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import codec


def test_frame_roundtrip_ids(spark):
    df = spark.createDataFrame([(42, "hello"), (3_000_000_000, "x"), (0, "")],
                               "sid bigint, body string")
    f = df.select("sid", codec.frame("sid", F.encode("body", "UTF-8")).alias("v"))
    out = f.select("sid", codec.unframe("v").alias("u"), F.octet_length("v").alias("n"))
    got = {r.sid: (r.u.magic, r.u.schema_id, r.n, r.u.problem) for r in out.collect()}
    assert got[42] == (0, 42, 10, None)
    assert got[3_000_000_000] == (0, 3_000_000_000, 6, None)
    assert got[0] == (0, 0, 5, None)


def test_unframe_exact_bytes_and_problems(spark):
    df = spark.createDataFrame(
        [(bytes.fromhex("000000002A") + b"abcde",), (bytes.fromhex("0100000001") + b"z",),
         (bytes.fromhex("0000"),), (None,)], "v binary")
    out = [r.u for r in df.select(codec.unframe("v").alias("u")).collect()]
    assert (out[0].magic, out[0].schema_id, bytes(out[0].body), out[0].problem) == \
        (0, 42, b"abcde", None)
    assert out[1].problem == "bad_magic"
    assert out[2].problem == "short_frame" and out[2].schema_id is None
    assert out[3].problem == "missing_value"


def test_iso_parse_both_spellings(spark):
    texts = ["2026-09-23T06:57:12.345Z", "2026-09-23T12:00:00+00:00",
             "2026-09-23T12:00:00.123456+00:00", "nope"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(codec.iso_parse("t").cast("timestamp_ntz")).collect()]
    assert got == [dt.datetime(2026, 9, 23, 6, 57, 12, 345000), dt.datetime(2026, 9, 23, 12),
                   dt.datetime(2026, 9, 23, 12, 0, 0, 123456), None]


def test_iso_format_truncates_to_ms(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 9, 23, 6, 57, 12, 345678),),
                                (dt.datetime(2026, 9, 23, 12, 0, 0),)], "t timestamp_ntz")
    got = df.select(codec.iso_format(F.col("t").cast("timestamp")).alias("a"),
                    codec.iso_format_offset(F.col("t").cast("timestamp")).alias("b")).collect()
    assert got[0].a == "2026-09-23T06:57:12.345Z"
    assert got[0].b == "2026-09-23T06:57:12.345678+00:00"
    assert got[1].b == "2026-09-23T12:00:00+00:00"


def test_json_roundtrip(spark):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "k string, x double")
    enc = df.select(codec.json_encode(F.struct("k", "x")).alias("v"))
    texts = sorted(bytes(r.v).decode() for r in enc.collect())
    assert texts == ['{"k":"a","x":1.5}', '{"k":"b"}']
    dec = enc.select(codec.json_decode("v", "k string, x double").alias("r")).select("r.*")
    assert sorted(map(tuple, dec.collect()), key=str) == [("a", 1.5), ("b", None)]


def test_minus_seconds_and_truncate(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 12, 194062),)], "t timestamp_ntz")
    r = df.select(codec.minus_seconds(codec.truncate_ms(F.col("t").cast("timestamp")), 5)
                  .cast("timestamp_ntz")).first()[0]
    assert r == dt.datetime(2024, 1, 1, 0, 0, 7, 194000)


def test_frame_rejects_ids_out_of_range(spark):
    df = spark.createDataFrame([(2**32,), (-1,), (2**32 - 1,)], "sid bigint")
    got = [r.v for r in df.select(codec.frame("sid", F.lit(b"x")).alias("v")).collect()]
    assert got[0] is None and got[1] is None and bytes(got[2]) == bytes.fromhex("00FFFFFFFF") + b"x"


def test_arrival_day_is_floor(spark):
    from tidemark.sources.relations import arrival_day
    ts = [dt.datetime(1970, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59),
          dt.datetime(2024, 1, 1, 23, 59, 59, 999999), dt.datetime(2024, 1, 2)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    got = [r[0] for r in df.select(arrival_day(F.col("t").cast("timestamp"))).collect()]
    assert got == [0, -1, 19723, 19724]
