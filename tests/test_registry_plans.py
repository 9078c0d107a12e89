"""Every registered query: no cross product, no nested-loop join, no Python evaluation in the plan."""

from __future__ import annotations

import pytest
from ledger_helpers import SF_SMALL

from ledgerday.registry import QUERIES
from plan_inspect import physical_plan

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    plan = physical_plan(QUERIES[name](spark, SF_SMALL))
    assert not [op for op in FORBIDDEN if op in plan]
