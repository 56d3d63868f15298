"""Every registered query beside its DuckDB twin. TEST_SF_DIR chooses the scale."""

import pytest

from oracle_check import compare, duck

from __spark_entry__ import entry
from strata.plans.registry import ORACLE as SQL, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert not entry(spark).isEmpty()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_duckdb(spark, sf, con, name):
    ok, note = compare(QUERIES[name](spark, sf), con, SQL[name])
    assert ok, note
