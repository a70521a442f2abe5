"""Every query against its SQL, and the contract of the entry module."""

import os

import __spark_entry__ as contract
import pytest
from oracle_compare import compare, connect

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(contract.QUERIES) == set(contract.ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_query(spark, duck, name):
    assert compare(contract.queries()[name](spark, SF), duck, contract.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_plan(spark, name):
    """No cross join, no all-pairs join, no Python in any plan."""
    plan = contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "NestedLoopJoin", "Python", "Arrow"):
        assert operator not in plan


@pytest.mark.parametrize("name", ["diff_stats", "action_batches", "assignment_updates", "payroll_updates"])
def test_diffs_make_each_record_once(spark, name):
    """Cells are written once; the filters on them used to make every VARIANT again, and batches the whole diff."""
    plan = contract.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "variant" not in plan.lower()
    assert plan.count("Join FullOuter") == {"action_batches": 0, "diff_stats": 2}.get(name, 1)
