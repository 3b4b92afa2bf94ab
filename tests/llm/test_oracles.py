"""Training-data queries that SQL expresses, against it."""

import os

import pytest

from quarrymill.llm.queries import ORACLE_SQL, QUERIES

from ..oracle import compare, duck

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    compare(duck(SF), QUERIES[name](spark, SF), ORACLE_SQL[name])
