"""Every registered query runs; those with SQL agree with it; none plans a cross join."""

import pytest
from oracle import compare, connect

from wattframe.plans.registry import load_all

SF = "/root/testdata/sf0.001"
QUERIES = load_all()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    query = QUERIES[name]
    df = query.run(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = df.toPandas()
    if query.sql is not None:
        problem = compare(got, con.execute(query.oracle()).df())
        assert problem is None, problem


def test_entry_and_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns == ["pool", "date", "block_no", "value", "forecast", "ape"]
    assert set(contract.oracle_sql()) <= set(contract.queries())
