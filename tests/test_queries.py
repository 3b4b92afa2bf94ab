"""Every registered query against its SQL, and those without SQL against their invariants."""

import os

import pytest

import __spark_entry__ as entry
from quarrymill.registry import ORACLES, QUERIES

from .oracle import compare, duck

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, con, name):
    compare(con, QUERIES[name](spark, SF), ORACLES[name])


def test_every_query_is_registered(spark):
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert entry.entry(spark).count() >= 0
