"""Registered queries against DuckDB on the smallest tables."""

from __future__ import annotations

import pytest
from compare import compare, duck
from conftest import SF

import __spark_entry__ as entry

# The slowest ones run in tests/compare.py only.
SLOW = {"incremental_equals_full", "export_marts", "ingest_stream", "replay_dead_letters"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - SLOW))
def test_query_matches_sql(spark, con, name):
    problem = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF)
    # Some rules find nothing on this few rows.
    assert problem in (None, "both empty"), problem


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 6
