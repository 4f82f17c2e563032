"""Every registered query against its comparison SQL, on the smallest test tables."""

import math
import os
import re

import duckdb
import pytest

import __spark_entry__

FOLDER = os.environ.get("TIDEMARK_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


# The queries of the text operators have tests of their own.
OWN = sorted(n for n in __spark_entry__.queries() if n != "pipeline" and not re.match(r"op[0-9]+_", n))


def test_every_query_has_comparison_sql():
    assert set(OWN) <= set(__spark_entry__.oracle_sql())


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["event_id", "model_name", "score"]


@pytest.mark.parametrize("name", OWN)
def test_query_matches(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, FOLDER)
    expected = duck.sql(__spark_entry__.oracle_sql()[name])
    assert sorted(df.columns) == sorted(expected.columns)
    got, want = _rows(df.columns, df.collect()), _rows(expected.columns, expected.fetchall())
    assert len(got) == len(want)
    assert got == want
