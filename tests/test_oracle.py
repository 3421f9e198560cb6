"""Every registered query against its DuckDB statement on the smallest generated tables."""

import pytest

from listenscape.plans import registry

import __spark_entry__ as E
from listenscape.checks.compare import compare, duckdb_connection

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF)


def test_every_query_registered_with_sql_or_marked_rows_only():
    rows_only = set(registry.QUERIES) - set(SQL)
    assert rows_only == {"reduced_components", "segment_matrix"}
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF), con, SQL[name])
    assert r["columns_match"], (r["spark_columns"], r["oracle_columns"])
    assert r["rows_spark"] == r["rows_oracle"]
    assert r["values_match"], r["first_diff"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["segment", "gigya_id", "key", "listen_number_time"]
    assert df.count() > 0
