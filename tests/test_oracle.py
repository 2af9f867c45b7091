"""Every oracle-checked query equals its DuckDB twin (rows, columns, values)."""

import pytest

from oracle import compare, duck
from conftest import SF_SMALL

import __spark_entry__ as E

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    problems, n = compare(df, con, ORACLE[name])
    assert not problems, f"{name}: {problems}"
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert op not in plan, f"{name} plans a {op}"


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["type", "fraud", "total", "pct"]
