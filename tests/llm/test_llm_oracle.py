"""Corpus queries with SQL equal their DuckDB statement on sf0.001."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

from check_oracle import TABLES, digest  # noqa: E402

from ledgermatch.llm.oracle import ORACLE  # noqa: E402
from ledgermatch.llm.queries import QUERIES  # noqa: E402

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF0001)
    rel = duck.sql(ORACLE[name])
    rows, expected = [tuple(r) for r in df.collect()], rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, rows) == digest(rel.columns, expected)


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
