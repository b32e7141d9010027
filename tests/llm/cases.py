"""Small tables with everything that may go wrong in them, and brute-force versions of operators."""

import re
import zlib

LONG = "wort " * 6000 + "+1 (980) 555-6268 " + "x" * 20000

#: doc_id, text, source: nulls, empty and very long texts, ties, repeated rows.
DOCS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "a"),
    (2, "the quick brown fox jumps over the lazy dog near the river bank today", "b"),
    (3, None, "a"), (4, "", None), (5, "   \n\t ", "b"), (None, "null id with a text of its own here", "a"),
    (6, LONG, None), (7, "one", "a"), (8, "two words", "c"), (9, "two words", "c"), (9, "two words", "c"),
    (10, "mail me at jane.doe@example.com or +1 (980) 555-6268, again 9805556268 and 194.238.35.204 card 4111 1111 1111 1111", "c"),
    (11, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.", "c"),
    (12, "é€😀 <|endoftext|> ǅ İ K ﬁ", "a"), (None, None, None), (None, None, None),
]
SCHEMA = "doc_id long, text string, source string"


def docs(spark, rows=DOCS, clash=True):
    """The table, with extra columns whose names operators use themselves."""
    df = spark.createDataFrame(rows, SCHEMA)
    if clash:
        from pyspark.sql import functions as F
        for c in ("size", "key", "row", "score", "print", "length", "bucket", "spans", "n_email", "labels", "id", "h", "v"):
            df = df.withColumn(c, F.lit("x"))
    return df


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def rest(doc_id, mod):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % mod


def bag(df, *cols):
    rows = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(rows, key=lambda t: [(x is not None, str(type(x)), x) if not isinstance(x, bool) else (True, "b", x) for x in t])


def roots(n, links):
    """Smallest index reachable, for each of n."""
    up = list(range(n))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
