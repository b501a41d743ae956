"""Every registered query with a DuckDB equivalent agrees with it on the smallest tables, value by value."""

import compare
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidewalk.plans.catalog import QUERIES

# Fits whose results have no closed form; stump_*, refit_* and garch_fit_checks hold the same code against SQL.
WITHOUT_ORACLE = {"garch_fit", "cv_random_forest", "cv_random_forest_garch"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.duck(sf_dir)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_duckdb(spark, con, sf_dir, name):
    assert compare.differences(queries()[name](spark, sf_dir), con, oracle_sql()[name]) == []


def test_only_library_seeded_queries_lack_an_oracle():
    assert set(QUERIES) - set(oracle_sql()) == WITHOUT_ORACLE
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_the_snapshot_columns(spark):
    df = entry(spark)
    assert len(df.columns) == 49 and df.columns[0] == "series_id"
