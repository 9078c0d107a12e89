"""Plan checks used by the tests: what the physical plan scans and how it joins."""

from __future__ import annotations

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    """The physical plan as text (the initial plan when AQE is on)."""
    return df._jdf.queryExecution().executedPlan().toString()


def formatted_plan(df: DataFrame) -> str:
    """What ``df.explain("formatted")`` prints, as a string."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def scan_count(df: DataFrame, path_fragment: str) -> int:
    """File scans of a path in the physical plan (a reused exchange is not a scan)."""
    return sum(1 for line in physical_plan(df).splitlines() if "FileScan" in line and path_fragment in line)


def join_kinds(df: DataFrame) -> set[str]:
    plan = physical_plan(df)
    kinds = {"BroadcastNestedLoopJoin", "CartesianProduct", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin"}
    return {k for k in kinds if k in plan}


def final_plan(df: DataFrame) -> str:
    """Run ``df`` (collecting its rows: for small results) and return AQE's final physical plan.

    With AQE on, exchange reuse is decided while the query runs, so only the
    final plan shows what was actually scanned.
    """
    df.collect()
    return physical_plan(df).split("Initial Plan")[0]


def final_scan_count(df: DataFrame, path_fragment: str) -> int:
    return sum(1 for line in final_plan(df).splitlines() if "FileScan" in line and path_fragment in line)
