"""E1–E4, J1 — availability rows, the readiness gate and the alerts.

A date is ready when the ledger holds, for that date, at least one coal line
issued, one maize line issued and one ethanol line received (production
code, positive quantity, exact and case-sensitive item name).  The three
counts come from **one** scan and one aggregate with conditional counts; the
per-date aggregate is combined map-side, so a date holding a third of the
ledger costs one partial row per task, not a hot shuffle key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerday.functions import items as it
from ledgerday.functions.dates import DateLike, as_date, in_months_of, ledger_span, within
from ledgerday.params import DEFAULT_ITEMS, Items

MATERIALS = ("coal", "maize", "ethanol")


def _material_condition(material: str, items: Items) -> Column:
    qty = "qtyrecd" if material == "ethanol" else "qtyissued"
    return (F.col("item_name") == F.lit(items.material_item(material))) & (F.col(qty) > 0)


def availability_rows(
    ledger: DataFrame,
    material: str,
    report_date: DateLike | None = None,
    items: Items = DEFAULT_ITEMS,
) -> DataFrame:
    """The lines that prove a material for a date (every date when none is given)."""
    rows = ledger.where(F.col("tcode") == F.lit(items.production_code)).where(_material_condition(material, items))
    if report_date is not None:
        d = as_date(report_date)
        rows = within(rows, d, d)
    if material == "ethanol":
        return rows.select(
            "vrdate",
            F.lit(items.ethanol_label).alias("item_name"),
            it.row_tonnes("qtyrecd", "um", items).alias("qty_received"),
        )
    return rows.select(
        "vrdate",
        it.product_name("item_name", items, compare_upper=False).alias("item_name"),
        it.row_tonnes("qtyissued", "um", items).alias("qty_issued"),
    )


def report_readiness(
    ledger: DataFrame,
    dates: DataFrame | None = None,
    items: Items = DEFAULT_ITEMS,
    between: tuple[DateLike, DateLike] | None = None,
    months: list[dt.date] | None = None,
) -> DataFrame:
    """``report_date, coal_rows, maize_rows, ethanol_rows, ready``.

    Without ``dates`` every day of the calendar from the ledger's first to its
    last line appears; with ``dates`` (a ``report_date`` column) every wanted
    one.  A day without a production line has zero counts: that is what the
    alerts are for.  A ledger stored by month is read in the wanted months only
    (``between`` gives literal bounds, ``months`` the months if known).
    """
    rows = ledger.where(F.col("vrdate").isNotNull())
    if between is not None:
        rows = within(rows, *between)
    elif dates is not None:
        rows = in_months_of(rows, dates, months)
    if dates is None:
        # The calendar's bounds read the date column alone.
        wanted = ledger_span(rows)
    else:
        wanted = dates.select(F.col("report_date").cast("date").alias("report_date")).distinct()
    # Code and items are literals on columns of the source, so they reach the scan.
    rows = rows.where(
        (F.col("tcode") == F.lit(items.production_code)) & F.col("item_name").isin(items.coal, items.maize, items.ethanol)
    )
    counts = rows.groupBy(F.col("vrdate").alias("report_date")).agg(
        *[F.count_if(_material_condition(m, items)).alias(f"{m}_rows") for m in MATERIALS]
    )
    counts = wanted.join(counts, "report_date", "left").select(
        "report_date", *[F.coalesce(f"{m}_rows", F.lit(0)).cast("bigint").alias(f"{m}_rows") for m in MATERIALS]
    )
    ready = F.lit(True)
    for m in MATERIALS:
        ready = ready & (F.col(f"{m}_rows") > 0)
    return counts.withColumn("ready", ready)


def availability_alerts(readiness: DataFrame, materials: tuple[str, ...] = ("coal", "maize")) -> DataFrame:
    """One row per (date, material) with no proving line; ethanol raises none by default."""
    missing = F.array(*[F.when(F.col(f"{m}_rows") == 0, F.lit(m)) for m in materials])
    return readiness.select(
        "report_date", F.explode(F.filter(missing, lambda x: x.isNotNull())).alias("material")
    )
