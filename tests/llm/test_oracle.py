"""Queries that SQL can express against that SQL."""

import duckdb
import pytest

from tidemark.llm import oracle, queries

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_matches(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    expected = con.sql(oracle.ORACLE[name])
    df = queries.QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(expected.columns)
    want = sorted(map(str, expected.project(", ".join(df.columns)).fetchall()))
    assert sorted(str(tuple(r)) for r in df.collect()) == want
