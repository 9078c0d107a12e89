"""B6–B8, E5, D1, J3, J4 — the sales report for one date: today against month-to-date.

Semantics kept on purpose:

* every exclusion filter drops NULLs (three-valued logic);
* the day side groups by the *raw* item name, the month side by the
  upper-cased name, and the two are joined on the product name only, so a
  product with several units or case variants fans out (``sales_report``);
  ``sales_report_by_unit`` groups both sides by (product, upper unit) instead;
* a ``kgs`` total (any case) is shown in tonnes rounded to 2, any other
  total is the raw sum; averages divide the unrounded total by the calendar
  day of the month.

Plan: one scan of the month-to-date range (date bounds and exclusion filters
pushed into the scan) and one partial + final hash aggregate per (raw item
name, unit) that takes both the month's and the day's sums at once (the day's
as conditional sums).  The day side is its groups seen on the day, the month
side re-groups it by the upper-cased name; both read the aggregate's one
shuffle (a reused exchange), and the two small results are joined, which AQE
plans as a broadcast hash join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerday.functions import items as it
from ledgerday.functions import numtext as nt
from ledgerday.functions.dates import DateLike, as_date, within
from ledgerday.params import DEFAULT_ITEMS, Items
from ledgerday.session import materialize as checkpointed


def sales_rows(ledger: DataFrame, items: Items = DEFAULT_ITEMS) -> DataFrame:
    """Sale lines that count: no returns, no scrap, no cancelled party (NULLs and empty strings drop out)."""
    return (
        ledger.where(F.col("tcode") == F.lit(items.sale_code))
        # The source database takes an empty string for NULL, and so no comparison with one holds.
        .where((F.col("item_nature") != "") & ~F.col("item_nature").isin(*items.return_natures))
        .where((F.trim("item_name") != "") & ~F.upper(F.trim("item_name")).isin(*items.scrap))
        .where((F.col("acc_name") != "") & (F.col("acc_name") != F.lit(items.cancelled_party)))
        .withColumn("product_name", it.product_name("item_name", items))
    )


def _day_of(report_date) -> Column:
    return F.lit(report_date.day) if hasattr(report_date, "day") else F.dayofmonth(report_date)


def sales_day(ledger: DataFrame, report_date: DateLike, items: Items = DEFAULT_ITEMS) -> DataFrame:
    """The day's sales per raw item name and unit."""
    d = as_date(report_date)
    rows = within(sales_rows(ledger, items), d, d)
    g = rows.groupBy("item_name", "aum").agg(F.sum("aqtyissued").alias("s"), F.count("vrno").alias("n"))
    return g.select(
        it.product_name("item_name", items).alias("product_name"),
        "aum",
        it.total_value(F.col("s"), F.col("aum"), items).alias("qty"),
        it.unit_label(F.col("aum"), items).alias("unit"),
        F.col("n").cast("bigint").alias("no_of_trucks"),
    )


def sales_mtd(
    ledger: DataFrame,
    report_date: DateLike,
    month_start: DateLike | None = None,
    items: Items = DEFAULT_ITEMS,
) -> DataFrame:
    """Month-to-date totals and daily averages per upper-cased item and unit."""
    d = as_date(report_date)
    ms = as_date(month_start) if month_start is not None else d.replace(day=1)
    rows = within(sales_rows(ledger, items), ms, d)
    g = rows.groupBy(F.upper("item_name").alias("item_upper"), "aum").agg(
        F.sum("aqtyissued").alias("s"), F.count("vrno").alias("n")
    )
    day = _day_of(d)
    return g.select(
        it.product_name("item_upper", items).alias("product_name"),
        "aum",
        it.total_value(F.col("s"), F.col("aum"), items).alias("tot_qty"),
        it.average_value(F.col("s"), F.col("aum"), day, items).alias("avg_qty"),
        it.unit_label(F.col("aum"), items).alias("unit"),
        F.col("n").cast("bigint").alias("tot_no_of_trucks"),
        F.round(F.col("n") / day).cast("bigint").alias("avg_no_of_trucks"),
    )


def month_groups(by_unit: bool) -> list[Column]:
    """Grouping of the month side: (product, upper-cased name, unit), or (product, upper unit) by unit.

    product_name is a function of the upper-cased name, so grouping by both
    forms the same groups as by the upper-cased name alone.
    """
    if by_unit:
        return [F.col("product_name"), F.upper("aum").alias("m_aum")]
    return [F.col("product_name"), F.upper("item_name").alias("item_upper"), F.col("aum").alias("m_aum")]


def day_side(day_src: DataFrame, keys: tuple[str, ...], by_unit: bool) -> DataFrame:
    """``keys, product_name, d_aum, d_s, d_n`` from rows summed per (``keys``, raw item name, unit)."""
    keys = list(keys)
    if by_unit:
        return day_src.groupBy(*keys, "product_name", F.upper("aum").alias("d_aum")).agg(
            F.sum("s").alias("d_s"), F.sum("n").alias("d_n")
        )
    # Already one row per (keys, raw item, unit).
    return day_src.select(
        *keys, "product_name", F.col("aum").alias("d_aum"), F.col("s").alias("d_s"), F.col("n").alias("d_n")
    )


def month_side(month_src: DataFrame, keys: tuple[str, ...], by_unit: bool) -> DataFrame:
    """``keys, product_name, m_aum, m_s, m_n`` from rows summed per (``keys``, raw item name, unit)."""
    keys = list(keys)
    month = month_src.groupBy(*keys, *month_groups(by_unit)).agg(F.sum("s").alias("m_s"), F.sum("n").alias("m_n"))
    return month.select(*keys, "product_name", "m_aum", "m_s", "m_n")


def join_sides(day: DataFrame, month: DataFrame, keys: tuple[str, ...], by_unit: bool) -> DataFrame:
    """Month side LEFT JOIN day side on (``keys``, product) — and the unit, by unit.

    Both sides are aggregates (products x units per date), so the join is
    small and AQE turns it into a broadcast hash join at run time.  The keys
    are compared null-safely: key columns hold no NULL (the unit may, in the
    by-unit form), and ``<=>`` lets Catalyst infer no not-null filter into one
    side only, which would make the two sides' shared aggregate differ and be
    computed twice.
    """
    keys = list(keys)
    m = month.alias("m")
    d = day.withColumn("d_hit", F.lit(True)).alias("d")
    cond = [F.col(f"m.{k}").eqNullSafe(F.col(f"d.{k}")) for k in keys + ["product_name"]]
    if by_unit:
        cond.append(F.col("m.m_aum").eqNullSafe(F.col("d.d_aum")))
    return m.join(d, cond, "left").select(
        *[F.col(f"m.{k}") for k in keys],
        F.col("m.product_name"),
        F.col("m.m_aum"),
        F.col("m.m_s"),
        F.col("m.m_n"),
        F.col("d.d_aum"),
        F.col("d.d_s"),
        F.col("d.d_n"),
        F.coalesce(F.col("d.d_hit"), F.lit(False)).alias("d_hit"),
    )


def typed_columns(day: Column, items: Items) -> list[Column]:
    hit = F.col("d_hit")
    return [
        F.col("product_name"),
        F.when(hit, it.total_value(F.col("d_s"), F.col("d_aum"), items)).otherwise(F.lit(0)).alias("qty"),
        F.when(hit, it.unit_label(F.col("d_aum"), items)).alias("day_unit"),
        F.coalesce(F.col("d_n"), F.lit(0)).cast("bigint").alias("no_of_trucks"),
        it.total_value(F.col("m_s"), F.col("m_aum"), items).alias("tot_qty"),
        it.average_value(F.col("m_s"), F.col("m_aum"), day, items).alias("avg_qty"),
        it.unit_label(F.col("m_aum"), items).alias("unit"),
        F.col("m_n").cast("bigint").alias("tot_no_of_trucks"),
        F.round(F.col("m_n") / day).cast("bigint").alias("avg_no_of_trucks"),
    ]


def text_columns(day: Column, items: Items) -> list[Column]:
    n = F.coalesce(F.col("d_n"), F.lit(0))
    avg_trucks = F.round(F.col("m_n") / day).cast("bigint")
    return [
        F.col("product_name"),
        F.when(F.col("d_hit"), nt.total_text(F.col("d_s"), F.col("d_aum"), items)).otherwise(F.lit("0")).alias("qty"),
        F.when(n == 0, F.lit("")).otherwise(n.cast("string")).alias("no_of_trucks"),
        F.concat(
            nt.total_text(F.col("m_s"), F.col("m_aum"), items),
            F.lit("/ "),
            nt.average_text(F.col("m_s"), F.col("m_aum"), day, items),
        ).alias("tot_avg_qty"),
        F.concat(F.col("m_n").cast("string"), F.lit("/ "), avg_trucks.cast("string")).alias("tot_avg_trucks"),
    ]


def _frame(ledger, report_date, month_start, items, by_unit, materialize=False):
    d = as_date(report_date)
    ms = as_date(month_start) if month_start is not None else d.replace(day=1)
    rows = within(sales_rows(ledger, items), min(ms, d), d)
    today = F.col("vrdate") == F.lit(d)
    # One pass: month and day sums per raw item and unit (the day's as
    # conditional sums).  Both sides read this aggregate; its sums sit in one
    # struct so that neither side prunes the other's, and the day test is on
    # an aggregate value, so no filter is pushed into one side only: the two
    # sides' plans below it are identical and AQE reuses its shuffle (one
    # scan).  ``materialize`` checkpoints it instead (items x units rows).
    groups = rows.groupBy("item_name", "aum", "product_name").agg(
        F.struct(
            F.sum("aqtyissued").alias("s"),
            F.count("vrno").alias("n"),
            F.sum(F.when(today, F.col("aqtyissued"))).alias("s_day"),
            F.count(F.when(today, F.col("vrno"))).alias("n_day"),
            F.max(today).alias("seen_today"),
        ).alias("a")
    )
    if ms > d:  # an empty month-to-date range: no report rows
        groups = groups.where(F.lit(False))
    if materialize:
        groups = checkpointed(groups)
    day_src = groups.where(F.col("a.seen_today")).select(
        "item_name", "aum", "product_name", F.col("a.s_day").alias("s"), F.col("a.n_day").alias("n")
    )
    month_src = groups.select("item_name", "aum", "product_name", F.col("a.s").alias("s"), F.col("a.n").alias("n"))
    day, month = day_side(day_src, (), by_unit), month_side(month_src, (), by_unit)
    return join_sides(day, month, (), by_unit), F.lit(d.day)


def sales_report(
    ledger: DataFrame,
    report_date: DateLike,
    month_start: DateLike | None = None,
    items: Items = DEFAULT_ITEMS,
    materialize: bool = False,
) -> DataFrame:
    """Typed report rows (month side right-joined to the day side on product).

    ``materialize=True`` checkpoints the shared aggregate to the shared folder
    (a job at call time; the sides then read the checkpoint and a lost
    executor does not rescan the ledger).
    """
    frame, day = _frame(ledger, report_date, month_start, items, False, materialize)
    return frame.select(*typed_columns(day, items))


def sales_report_by_unit(
    ledger: DataFrame,
    report_date: DateLike,
    month_start: DateLike | None = None,
    items: Items = DEFAULT_ITEMS,
    materialize: bool = False,
) -> DataFrame:
    """Variant without fan-out: both sides keyed by (product, upper unit)."""
    frame, day = _frame(ledger, report_date, month_start, items, True, materialize)
    return frame.select(*typed_columns(day, items))


def sales_report_text(
    ledger: DataFrame,
    report_date: DateLike,
    month_start: DateLike | None = None,
    items: Items = DEFAULT_ITEMS,
    by_unit: bool = False,
    materialize: bool = False,
) -> DataFrame:
    """The report's text columns, ordered by product and unit."""
    frame, day = _frame(ledger, report_date, month_start, items, by_unit, materialize)
    return frame.orderBy("product_name", "m_aum").select(*text_columns(day, items))
