import re

import pytest

import __spark_entry__ as driver
from checks import queries as checked
from checks.compare import difference, duck


@pytest.fixture(scope="module")
def connection(folder):
    return duck(folder)


# No row of the smallest tables is meant.
EMPTY_HERE: set[str] = set()


@pytest.mark.parametrize("name", list(checked.QUERIES))
def test_query_agrees_with_its_oracle(spark, folder, connection, name):
    rows = driver.queries()[name](spark, folder).toPandas()
    oracle = connection.execute(driver.oracle_sql()[name]).df()
    assert difference(rows, oracle) is None
    assert len(rows) or name in EMPTY_HERE


def test_every_query_has_an_oracle():
    assert set(checked.ORACLE) == set(checked.QUERIES)


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["run_makro", "run_bigc", "run_lotus", "all_retailers"])
def test_plans_have_no_cross_joins(spark, folder, name):
    plan = driver.queries()[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
