"""Every registered query against its SQL."""

import pytest
from check import compare, connect

import __spark_entry__ as entry
from candlelake.queries import ORACLES, QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


def test_each_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, duck, folder, name):
    assert compare(spark, duck, folder, name, QUERIES[name], ORACLES[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
