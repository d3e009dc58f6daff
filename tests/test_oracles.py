"""Every registered query against its DuckDB oracle (sf0.001), and the smoke entry."""

import pytest

import __spark_entry__ as e
from table_dirs import SF_SMALL
from oracle import compare, duckdb_conn


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF_SMALL)


@pytest.mark.parametrize("name", sorted(e.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    out = compare(spark, name, SF_SMALL, con)
    assert out["columns_match"], out
    assert out["match"], out


def test_every_oracle_has_a_query():
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", sorted(set(e.queries()) - set(e.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    df = e.queries()[name](spark, SF_SMALL)
    assert df.count() > 0


def test_entry(spark):
    df = e.entry(spark)
    assert df.count() > 0
    assert "rank" in df.columns
