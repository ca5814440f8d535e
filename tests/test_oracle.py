"""Every registered query equals its DuckDB statement on sf0.001."""

import os
import sys

import duckdb
import pytest
from ledger_helpers import SF0001

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def test_every_library_query_has_oracle():
    assert set(entry.QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF0001)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(rel.columns, orows)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "recon_status" in df.columns
