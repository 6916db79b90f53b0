"""Every registered query against its DuckDB twin on sf0.001 (the driver
runs the same comparison at sf0.01), and plan hygiene for each."""

import pytest

import __spark_entry__ as E
from ledgerfleet.plans import registry
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
registry.load_all()
NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "status" in df.columns


def test_every_query_has_an_oracle():
    missing = set(NAMES) - set(E.oracle_sql())
    assert not missing, missing
    assert set(NAMES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, SF, name, E.queries()[name], E.oracle_sql().get(name))
    assert r["ok"] is not False, r


@pytest.mark.parametrize("name", NAMES)
def test_no_pairwise_joins(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
