"""Every registered query of the library's own metrics: its plan, and its result against the comparison SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks import registered
from checks.compare import difference, oracle
from tests.conftest import plan

SF = "/root/testdata/sf0.001"
QUERIES = registered.queries()
SQL = registered.oracle_sql()
# row pairs, and rows that leave the JVM
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups")


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    text = plan(df, "simple")
    for operator in UNWANTED:
        assert operator not in text, operator
    _, problem = difference(df, con, SQL[name])
    assert problem is None


def test_entry(spark):
    assert entry.entry(spark).count() == 6
