"""Every query that has SQL gives what DuckDB gives."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    return c


def test_names():
    assert set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    rel = duck.sql(ORACLES[name])
    order = sorted(df.columns)
    assert order == sorted(rel.columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == dict(zip(rel.columns, map(str, rel.types), strict=True))
    mine = sorted(str([plain(r[c]) for c in order]) for r in df.collect())
    at = [rel.columns.index(c) for c in order]
    theirs = sorted(str([plain(r[i]) for i in at]) for r in rel.fetchall())
    assert mine == theirs
