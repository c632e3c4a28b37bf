"""Every registered query against its SQL counterpart, and its plan against nested loops."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from workload import check

SF = "/root/testdata/sf0.001"
# The queries of this folder's own registries; those for training data have their tests beside them.
QUERIES = {name: query for registry in entry._registries() for name, query in registry.queries.items()}
ORACLES = {name: sql for registry in entry._registries() for name, sql in registry.oracles.items()}


@pytest.fixture(scope="module")
def con():
    return check.duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert check.compare(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["period", "arr"] and df.count() == 80


def test_every_query_has_sql_unless_it_cannot():
    assert set(QUERIES) - set(ORACLES) == {"segment_accounts", "churn_scores"}
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_check_sees_differences(spark):
    con = duckdb.connect()
    df = spark.sql("select 1 as a, 'x' as b")
    assert check.compare(df, con, "select 'x' as b, 1 as a") is None
    assert "rows differ" in check.compare(df, con, "select 2 as a, 'x' as b")
    assert "types" in check.compare(df, con, "select cast(1 as bigint) as a, 'x' as b")
    assert "columns" in check.compare(df, con, "select 1 as c, 'x' as b")
    assert "rows 1 != 2" in check.compare(df, con, "select 1 as a, 'x' as b union all select 1, 'x'")
