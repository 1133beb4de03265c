"""Plan properties of every registered query: no cross joins, no Python row-at-a-time UDFs."""

from __future__ import annotations

from hexvault.plans import registry

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def test_no_cross_joins_or_row_udfs_in_any_query(spark):
    bad = {}
    for name, q in registry.QUERIES.items():
        plan = q(spark, SF)._jdf.queryExecution().executedPlan().toString()
        found = [op for op in FORBIDDEN if op in plan]
        if found:
            bad[name] = found
    assert bad == {}
