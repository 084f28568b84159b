"""Every registered query against its SQL counterpart."""

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from batchlens.catalog.oracles import ORACLES
from batchlens.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    rows, differences = compare(df, con, ORACLES[name])
    assert rows > 0
    assert not differences, differences[:5]
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython"):
        assert slow not in plan


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:2] == ["batch_id", "feature"]
    assert not df.isEmpty()
