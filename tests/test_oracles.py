"""Every registered query with SQL must equal DuckDB on the smallest supplied tables."""

from __future__ import annotations

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from tidepool.tables import TABLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    return repr(value)


def test_contract():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, oracle, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    result = oracle.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["c_custkey", "c_name", "c_acctbal", "n_name", "revenue"]
