"""Every registered query next to its SQL in DuckDB, on the small tables."""

from __future__ import annotations

import pytest

import oracle_check
from frostline.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle_check.duck(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    problem, rows = oracle_check.compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
    assert problem is None, problem


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())
