"""Frames, JSON values and ISO-8601 text as Spark column expressions.

All functions map columns to columns; everything stays JVM-side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed values of the framed wire format: one magic byte (always 0), then a
# 4-byte big-endian schema id, then the encoded body.
MAGIC_BYTE = 0
HEADER_BYTES = 5
MAX_SCHEMA_ID = 2**32 - 1

# Fixed value: millisecond ISO-8601 text with a trailing Z (UTC).
ISO_MS_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def frame(schema_id: Column | str, body: Column | str) -> Column:
    """magic byte + 4-byte big-endian id + body (binary); null when the id
    does not fit in 4 unsigned bytes."""
    sid = _col(schema_id).cast("bigint")
    header = F.unhex(F.concat(F.lit("%02X" % MAGIC_BYTE), F.lpad(F.hex(sid), 8, "0")))
    fits = (sid >= 0) & (sid <= MAX_SCHEMA_ID)
    return F.when(fits, F.concat(header, _col(body).cast("binary")))


def unframe(value: Column | str) -> Column:
    """Split a framed value: struct(magic int, schema_id bigint, body binary,
    problem string).  ``problem`` is null for a sound frame, ``short_frame``
    for fewer than 5 bytes, ``bad_magic`` for a first byte other than 0."""
    v = _col(value).cast("binary")
    n = F.octet_length(v)
    short = n < HEADER_BYTES
    magic = F.conv(F.hex(F.substring(v, 1, 1)), 16, 10).cast("int")
    sid = F.conv(F.hex(F.substring(v, 2, 4)), 16, 10).cast("bigint")
    body = F.substring(v, HEADER_BYTES + 1, F.greatest(n - HEADER_BYTES, F.lit(0)))
    problem = (F.when(v.isNull(), F.lit("missing_value"))
               .when(short, F.lit("short_frame"))
               .when(magic != MAGIC_BYTE, F.lit("bad_magic")))
    return F.struct(
        F.when(short, None).otherwise(magic).alias("magic"),
        F.when(short, None).otherwise(sid).alias("schema_id"),
        F.when(short, None).otherwise(body).alias("body"),
        problem.alias("problem"),
    )


def json_encode(record: Column) -> Column:
    """UTF-8 JSON bytes of a struct (null fields are left out)."""
    return F.encode(F.to_json(record), "UTF-8")


def json_decode(value: Column | str, schema: StructType | str, mode: str = "PERMISSIVE") -> Column:
    """Parse UTF-8 JSON bytes (or text) into a struct of ``schema``.

    PERMISSIVE (default) turns bad text into null fields; FAILFAST raises.
    """
    text = F.decode(_col(value).cast("binary"), "UTF-8")
    return F.from_json(text, schema, {"mode": mode})


def iso_format(ts: Column | str) -> Column:
    """Millisecond ISO text with a trailing Z; microseconds are truncated."""
    return F.date_format(_col(ts), ISO_MS_PATTERN)


def iso_format_offset(ts: Column | str) -> Column:
    """Microsecond ISO text with a +00:00 offset; the fraction is left out
    when it is zero (the Python ``isoformat`` spelling)."""
    t = _col(ts)
    frac = F.when(F.unix_micros(t) % 1_000_000 == 0, F.lit("")).otherwise(
        F.date_format(t, ".SSSSSS"))
    return F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), frac, F.lit("+00:00"))


def iso_parse(text: Column | str) -> Column:
    """ISO-8601 text to an instant; accepts Z and +hh:mm, with or without a
    fraction; bad text gives null (never an error)."""
    return F.try_to_timestamp(_col(text))


def minus_seconds(ts: Column | str, seconds: float) -> Column:
    """ts - INTERVAL n SECONDS."""
    return _col(ts) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))


def truncate_ms(ts: Column | str) -> Column:
    return F.date_trunc("millisecond", _col(ts))


def encoded_length(value: Column | str) -> Column:
    return F.octet_length(_col(value))
