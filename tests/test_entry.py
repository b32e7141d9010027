"""The driver contract: entry() smoke run, and every query against its
DuckDB oracle on the smallest tables (row count, columns, values)."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.plans.oracle import SQL
from tests.conftest import SF_SMALL
from tidemark.sources.tables import TABLES

ROWS_ONLY: set[str] = set()
DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
              "binary": "BLOB"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return "∅" if v is None else str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == ["window_start", "window_end", "pickup_city",
                                                 "ride_count"]


def test_every_query_has_oracle_or_is_rows_only():
    from tidemark.plans.queries import QUERIES
    assert set(QUERIES) - set(E.oracle_sql()) == ROWS_ONLY
    assert set(QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(df.columns, got) == _bag(ocols, want)
    spark_types = {f.name: DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    duck_types = dict(zip(ocols, map(str, duck.sql(E.oracle_sql()[name]).types)))
    assert spark_types == duck_types


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF_SMALL).count() > 0
