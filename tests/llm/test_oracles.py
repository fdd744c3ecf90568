"""Operators that SQL can express, against DuckDB on whole tables."""

import duckdb
import pytest

from quorumrank.llm.queries import ORACLES, QUERIES

TABLES = ("documents", "pages", "embeddings")


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_operator_agrees_with_sql(spark, data, name, sf):
    folder = data.replace("0.001", sf)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    found = con.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    df = QUERIES[name](spark, folder)
    assert sorted(df.columns) == sorted(columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert got == sorted(found.fetchall(), key=repr)
