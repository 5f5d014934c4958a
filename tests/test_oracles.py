"""Every registered query gives the rows of its SQL oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracles.registry import ORACLES
from tidegate.plans.registry import QUERIES
from tools.compare import compare, oracle_connection


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, oracle, name):
    df = QUERIES[name](spark, sf_dir)
    ok, message = compare(df, df.collect(), oracle, ORACLES[name])
    assert ok, message


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["region_name", "month_date", "revenue"]


HAND_WRITTEN_PYTHON = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups")


@pytest.mark.parametrize("name", ["gold_monthly_revenue_by_region", "dq_leads", "contract_validate", "evidence_gate",
                                  "route_decisions", "reconcile_keyed", "payments_vs_orders"])
def test_plans_are_native(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in HAND_WRITTEN_PYTHON)
    assert "CartesianProduct" not in plan
