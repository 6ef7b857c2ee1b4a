"""Every driver query against DuckDB, and the shape of its plan."""

import pytest

import __spark_entry__ as driver
import oracle

SF = f"{oracle.TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


def test_every_query_has_its_sql():
    assert set(driver.order_queries()) <= set(driver.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", list(driver.order_queries()))
def test_query_equals_sql(spark, duck, name):
    df = driver.order_queries()[name](spark, SF)
    assert oracle.mismatch(df, duck, driver.oracle_sql()[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for python_or_pairs in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoop"):
        assert python_or_pairs not in plan


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["dimension", "segment", "total_orders", "total_qty", "total_revenue"]
    assert df.count() > 0
