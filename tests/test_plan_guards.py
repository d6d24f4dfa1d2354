"""Structural guards over every registered query's physical plan: no cartesian products or nested-loop
joins (no all-pairs work), and no Python evaluation nodes (everything stays in the JVM)."""
import pytest

from lakestrata.plans.registry import QUERIES
from conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_pairs_or_python(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    bad = [node for node in FORBIDDEN if node in plan]
    assert not bad, f"{name}: {bad}"
