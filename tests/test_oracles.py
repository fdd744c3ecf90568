"""Every query against its SQL in DuckDB on the smallest tables."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from quorumrank.plans.catalog import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{data}/{t}.parquet')")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)[:19].removesuffix(" 00:00:00")
    if isinstance(v, decimal.Decimal):
        v = float(v)
    return int(v) if isinstance(v, float) and v == int(v) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, data, con, name):
    df = QUERIES[name](spark, data)
    found = con.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    expected = sorted((tuple(plain(dict(zip(columns, r))[c]) for c in order) for r in found.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    assert got == expected


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
