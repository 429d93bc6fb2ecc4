"""Every catalogue query against its DuckDB oracle (or, without one, a run
with a stable schema) on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import TABLES, rows_sorted, type_mismatches
from conftest import SMALL

# The queries of the optional subpackage have their own tests.
from trendlake.plans import catalog, oracle

QUERIES = catalog.QUERIES
SQL = oracle.SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_query_is_registered_with_sql_or_rows_only():
    from trendlake.plans import catalog, oracle
    assert set(catalog.QUERIES) == set(oracle.SQL)
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    s_cols, s_rows = rows_sorted(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(SQL[name])
    o_cols, o_rows = rows_sorted([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == o_cols
    assert type_mismatches(df.schema, cur.description) == {}
    assert len(s_rows) == len(o_rows)
    assert s_rows == o_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["o_orderpriority", "year", "repo_count", "prev_count", "growth_rate_pct"]
    assert df.count() > 0
