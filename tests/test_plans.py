"""Plan checks: one scan where promised, no nested-loop joins, filters reach the scan."""

from __future__ import annotations

import re

import pytest
from ledger_helpers import SF_SMALL

from ledgerday.functions.dates import date_spine, ledger_span
from ledgerday.operators import availability as A
from ledgerday.operators import sales as S
from ledgerday.operators.sales_multi import sales_report_multi
from ledgerday.operators.sendlog import send_log_append, send_log_retained
from plan_inspect import final_scan_count, formatted_plan, join_kinds, physical_plan, scan_count
from ledgerday.session import scratch_path
from ledgerday.sources.fixtures import FIXTURE_ITEMS, fixture_ledger, fixture_send_log
from ledgerday.sources.ledger import read_ledger, write_ledger


@pytest.fixture
def static_plans(spark):
    """Plans without AQE, so that exchange reuse shows in the physical plan."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_readiness_filters_reach_the_scan(spark, static_plans):
    path = scratch_path(spark, "readiness-ledger")
    write_ledger(fixture_ledger(spark, SF_SMALL), path)
    plan = formatted_plan(A.report_readiness(read_ledger(spark, path), items=FIXTURE_ITEMS))
    scans = [p for p in plan.split("\n\n") if "Scan parquet" in p.strip().split("\n")[0]]
    counts, span = sorted(scans, key=len, reverse=True)
    assert "EqualTo(tcode" in counts and "In(item_name" in counts
    # The calendar's bounds: one column.
    assert re.search(r"ReadSchema: struct<vrdate:date>", span)
    dates = date_spine(spark, "1998-03-01", "1998-03-31")
    df = A.report_readiness(fixture_ledger(spark, SF_SMALL), dates, FIXTURE_ITEMS)
    assert scan_count(df, "lineitem.parquet") == 1


def test_multi_scans_once_without_nested_loops(spark, static_plans):
    ledger = fixture_ledger(spark, SF_SMALL)
    spine = date_spine(spark, "1995-01-01", "2001-12-31")
    lazy = sales_report_multi(ledger, spine, FIXTURE_ITEMS)
    assert scan_count(lazy, "lineitem.parquet") == 1
    assert "ReusedExchange" in physical_plan(lazy)
    # Materialized: both sides read the checkpointed daily aggregate, not the ledger,
    # also when the dates are the ledger's own span.
    for dates in (spine, ledger_span(ledger)):
        df = sales_report_multi(ledger, dates, FIXTURE_ITEMS, materialize=True)
        assert scan_count(df, "lineitem.parquet") == 0
        assert not join_kinds(df) & {"BroadcastNestedLoopJoin", "CartesianProduct"}


def test_single_date_scans_the_month_once(spark, static_plans):
    ledger = fixture_ledger(spark, SF_SMALL)
    for f in (S.sales_report, S.sales_report_by_unit):
        lazy = f(ledger, "1998-03-17", items=FIXTURE_ITEMS)
        assert scan_count(lazy, "lineitem.parquet") == 1 and "ReusedExchange" in physical_plan(lazy)
        kept = f(ledger, "1998-03-17", items=FIXTURE_ITEMS, materialize=True)
        assert scan_count(kept, "lineitem.parquet") == 0
        assert sorted(lazy.collect()) == sorted(kept.collect())


def test_shared_aggregates_scan_once_under_aqe(spark):
    # With AQE the shuffle is reused at run time: the final plans scan lineitem once.
    ledger = fixture_ledger(spark, SF_SMALL)
    assert final_scan_count(S.sales_report(ledger, "1998-03-17", items=FIXTURE_ITEMS), "lineitem.parquet") == 1
    spine = date_spine(spark, "1998-01-01", "1998-12-31")
    assert final_scan_count(sales_report_multi(ledger, spine, FIXTURE_ITEMS), "lineitem.parquet") == 1


def test_month_filter_reaches_the_scan(spark):
    df = S.sales_report(fixture_ledger(spark, SF_SMALL), "1998-03-17", items=FIXTURE_ITEMS, materialize=False)
    plan = formatted_plan(df)
    assert "GreaterThanOrEqual(l_shipdate,1998-03-01" in plan
    assert "LessThan(l_shipdate,1998-03-18" in plan


def test_stored_ledger_prunes_months(spark):
    path = scratch_path(spark, "ledger")
    write_ledger(fixture_ledger(spark, SF_SMALL), path)
    df = S.sales_report(read_ledger(spark, path), "1998-03-17", items=FIXTURE_ITEMS, materialize=False)
    plan = formatted_plan(df)
    assert "PartitionFilters: [isnotnull(vrmonth" in plan and "1998-03-01" in plan
    assert df.count() == S.sales_report(fixture_ledger(spark, SF_SMALL), "1998-03-17", items=FIXTURE_ITEMS).count()


def test_retention_limits_per_task(spark):
    plan = physical_plan(send_log_retained(fixture_send_log(spark, SF_SMALL), 10))
    assert "WindowGroupLimit" in plan


def test_stored_ledger_splits_a_hot_voucher_day(spark, ledger_of):
    # A third of the lines share one (date, voucher): the store still spreads them over several files.
    from pyspark.sql import functions as F

    hot = [dict(vrdate="2024-03-05", vrno=7, item_name=f"I{i % 50}", aqtyissued=i) for i in range(3000)]
    cold = [dict(vrdate=f"2024-03-{1 + i % 28:02d}", vrno=i, item_name="X", aqtyissued=i) for i in range(6000)]
    path = scratch_path(spark, "hot-ledger")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        write_ledger(ledger_of(hot + cold), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = read_ledger(spark, path)
    files = back.where((F.col("vrdate") == "2024-03-05") & (F.col("vrno") == 7)).select(F.input_file_name()).distinct()
    assert files.count() > 1
    assert back.count() == 9000


def test_wanted_dates_prune_a_stored_ledger(spark):
    path = scratch_path(spark, "ledger")
    write_ledger(fixture_ledger(spark, SF_SMALL), path)
    stored, lines = read_ledger(spark, path), fixture_ledger(spark, SF_SMALL)
    dates = spark.createDataFrame([("1996-02-29",), ("1999-03-17",)], "report_date string")
    months = r"vrmonth#\d+ IN \(1996-02-01,1999-03-01\)"
    multi = sales_report_multi(stored, dates, FIXTURE_ITEMS)
    ready = A.report_readiness(stored, dates, FIXTURE_ITEMS)
    for df in (multi, ready):
        filters = [x for x in formatted_plan(df).splitlines() if "PartitionFilters" in x]
        assert filters and all(re.search(months, x) for x in filters)
    assert sorted(multi.collect(), key=str) == sorted(sales_report_multi(lines, dates, FIXTURE_ITEMS).collect(), key=str)
    assert sorted(ready.collect()) == sorted(A.report_readiness(lines, dates, FIXTURE_ITEMS).collect())


def test_send_log_append_shuffles_twice(spark, log_of):
    new = spark.createDataFrame([("email", "2024-03-01")], "channel string, sent_date string")
    plan = physical_plan(send_log_append(log_of([("email", "2024-02-01", 0)]), new))
    assert plan.count("Exchange hashpartitioning") <= 2 and "Join" not in plan


def test_ledger_is_stored_in_one_read(spark, ledger_of):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    ledger = ledger_of([dict(vrdate="2024-03-05", vrno=i) for i in range(50)])
    write_ledger(ledger.mapInArrow(count, ledger.schema), scratch_path(spark, "one-read"))
    assert seen.value == 50
