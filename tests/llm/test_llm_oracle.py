"""The queries with SQL against DuckDB on the smallest driver tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from check_oracle import TABLES, rows_sorted, type_mismatches
from conftest import SMALL
from trendlake.llm import queries


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SMALL)
    s_cols, s_rows = rows_sorted(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(queries.SQL[name])
    o_cols, o_rows = rows_sorted([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == o_cols and type_mismatches(df.schema, cur.description) == {}
    assert s_rows == o_rows


def test_every_operator_is_registered():
    import __spark_entry__ as E
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
