"""Queries with a SQL twin, on the tables of the correctness check."""

import pytest
from conftest import SF_CHECK
from oracle import compare, duck

from txrisk.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    problems, n = compare(QUERIES[name](spark, SF_CHECK), con, ORACLE[name])
    assert not problems and n > 0, f"{name}: {problems}"
