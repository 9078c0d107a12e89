"""D5, J5 — the sales report for many report dates in one job.

Instead of one job per date, the ledger is aggregated once into daily totals
per (date, raw item name, unit).  Both sides of every date's report come from
that one aggregate:

* the day side is the daily row whose date *is* the report date (equi-join);
* the month side is a running sum over each month group's days (a window of
  at most 31 rows per month and group); each running row covers the report
  dates up to the group's next active day, and those are equi-joined to the
  wanted dates on ``report_date``.

No nested-loop or range join appears, and the month side generates only the
(date, group) pairs of its result (at sf0.1: 93,000 rows, where copying each
daily row to every later day of its month made 1.3 million).  The join key is
the report date, which spreads evenly however the ledger is skewed, and the
dates side is a calendar (one row per day), which AQE broadcasts once its
run-time size is known (sort-merge join otherwise).

Both sides read the daily aggregate, whose plan is identical in both (the
not-null conditions are stated once in :func:`daily_sales`, the final join
compares keys null-safely), so AQE reuses its shuffle: the ledger is scanned
once.  ``materialize=True`` checkpoints the daily aggregate (dates x items x
units rows) and the date list to the shared checkpoint folder instead, so that
a lost executor recomputes from the checkpoint, not from the ledger.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerday.functions.dates import DateLike, in_months_of, within
from ledgerday.operators.sales import day_side, join_sides, month_groups, sales_rows, text_columns, typed_columns
from ledgerday.params import DEFAULT_ITEMS, Items
from ledgerday.session import materialize as checkpointed


def daily_sales(
    ledger: DataFrame, items: Items = DEFAULT_ITEMS, between: tuple[DateLike, DateLike] | None = None
) -> DataFrame:
    """Sum and line count per (vrdate, raw item name, unit): the only pass over ledger lines.

    ``product_name`` rides along as a grouping key (it is a function of the
    item name); the not-null conditions both sides' joins imply are stated
    here, once, rather than inferred into each branch.
    """
    rows = sales_rows(ledger, items)
    if between is not None:
        rows = within(rows, *between)
    rows = rows.where(F.col("vrdate").isNotNull() & F.col("product_name").isNotNull())
    return rows.groupBy("vrdate", "item_name", "aum", "product_name").agg(
        F.sum("aqtyissued").alias("s"), F.count("vrno").alias("n")
    )


def multi_frame(
    ledger: DataFrame,
    dates: DataFrame,
    items: Items = DEFAULT_ITEMS,
    by_unit: bool = False,
    between: tuple[DateLike, DateLike] | None = None,
    materialize: bool = False,
    months: list[dt.date] | None = None,
) -> DataFrame:
    if between is None:
        ledger = in_months_of(ledger, dates, months)
    daily = daily_sales(ledger, items, between)
    wanted = dates.select(F.col("report_date").cast("date").alias("report_date")).distinct()
    if materialize:
        # Both are read by both sides; the dates are a calendar (one row per
        # day), the daily aggregate dates x items x units.
        daily, wanted = checkpointed(daily), checkpointed(wanted)
    day_src = daily.join(wanted, daily["vrdate"] == wanted["report_date"]).drop("vrdate")
    day = day_side(day_src, ("report_date",), by_unit)
    return join_sides(day, month_to_date(daily, wanted, by_unit), ("report_date",), by_unit)


def month_to_date(daily: DataFrame, wanted: DataFrame, by_unit: bool = False) -> DataFrame:
    """The month side of every wanted report date: ``report_date, product_name, m_aum, m_s, m_n``.

    Per month group and day the daily rows are summed, and a running sum over
    the month (a window partitioned by month and group: at most 31 rows each)
    gives the month-to-date totals at each day the group was active.  Each
    such row then stands for the report dates from its day up to the day
    before the group's next active day (or the month's end), so the rows
    generated are exactly the (date, group) pairs of the result, before the
    join to the wanted dates — not one copy of every daily row per later day
    of its month.
    """
    named = daily.select(F.trunc("vrdate", "MM").alias("month"), "vrdate", *month_groups(by_unit), "s", "n")
    groups = [c for c in named.columns if c not in ("month", "vrdate", "s", "n")]
    # One shuffle serves the re-grouping by day and the window over the month.
    dealt = named.repartition("month", *groups)
    per_day = dealt.groupBy("month", *groups, "vrdate").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    in_month = Window.partitionBy("month", *groups).orderBy("vrdate")
    so_far = in_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = per_day.select(
        *groups,
        "vrdate",
        F.sum("s").over(so_far).alias("m_s"),
        F.sum("n").over(so_far).alias("m_n"),
        F.lead("vrdate").over(in_month).alias("_next"),
    )
    until = F.coalesce(F.date_sub("_next", 1), F.last_day("vrdate"))
    carried = running.select(*groups, "m_s", "m_n", F.explode(F.sequence("vrdate", until)).alias("report_date"))
    return carried.join(wanted, "report_date").select("report_date", "product_name", "m_aum", "m_s", "m_n")


def sales_report_multi(
    ledger: DataFrame,
    dates: DataFrame,
    items: Items = DEFAULT_ITEMS,
    by_unit: bool = False,
    between: tuple[DateLike, DateLike] | None = None,
    materialize: bool = False,
    months: list[dt.date] | None = None,
) -> DataFrame:
    """``sales_report`` for every ``report_date`` of ``dates``, plus a ``report_date`` column.

    ``between`` optionally bounds the ledger scan (literal dates, pushed to
    the source); it must cover each report date's whole month-to-date range.
    Without it a ledger stored by month is read in the dates' months only;
    these are found by a small job unless ``months`` has them.
    """
    frame = multi_frame(ledger, dates, items, by_unit, between, materialize, months)
    return frame.select("report_date", *typed_columns(F.dayofmonth("report_date"), items))


def sales_report_multi_text(
    ledger: DataFrame,
    dates: DataFrame,
    items: Items = DEFAULT_ITEMS,
    by_unit: bool = False,
    between: tuple[DateLike, DateLike] | None = None,
    materialize: bool = False,
    months: list[dt.date] | None = None,
) -> DataFrame:
    frame = multi_frame(ledger, dates, items, by_unit, between, materialize, months)
    return frame.select("report_date", *text_columns(F.dayofmonth("report_date"), items))


def report_lines(frame: DataFrame, items: Items = DEFAULT_ITEMS) -> DataFrame:
    """The text form of a :func:`multi_frame`, each date's lines numbered from 1 in the report's order (product, unit)."""
    order = Window.partitionBy("report_date").orderBy("product_name", "m_aum", "d_aum", "m_s", "d_s", "m_n", "d_n")
    line = F.row_number().over(order).alias("line_no")
    return frame.select("report_date", line, *text_columns(F.dayofmonth("report_date"), items))
