"""Date helpers: literal parsing, range predicates that reach the scan, spines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerday.constants import DATE_TEXT_FORMAT
from ledgerday.schemas import MONTH_PARTITION

DateLike = dt.date | str


def as_date(value: DateLike) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def month_start(value: DateLike) -> dt.date:
    return as_date(value).replace(day=1)


def within(df: DataFrame, lo: DateLike | None, hi: DateLike | None, col: str = "vrdate") -> DataFrame:
    """Inclusive literal date range on ``col``.

    Literal bounds are pushed to the Parquet scan (row-group statistics) or
    the JDBC query; when the ledger is stored by month the matching bound on
    the partition column prunes whole directories as well.
    """
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(col) >= F.lit(as_date(lo)))
    if hi is not None:
        cond = cond & (F.col(col) <= F.lit(as_date(hi)))
    if MONTH_PARTITION in df.columns:
        if lo is not None:
            cond = cond & (F.col(MONTH_PARTITION) >= F.lit(month_start(lo)))
        if hi is not None:
            cond = cond & (F.col(MONTH_PARTITION) <= F.lit(month_start(hi)))
    return df.where(cond)


def in_months_of(df: DataFrame, dates: DataFrame | None, months: list[dt.date] | None = None, name: str = "report_date") -> DataFrame:
    """The rows of a month-stored ledger in the months of ``dates``: whole directories are pruned.

    The distinct months (a calendar: a few values) are read by a small job
    unless the caller knows them, and become literals on the partition column.
    A ledger that isn't stored by month, or no dates, is returned as it is.
    """
    if MONTH_PARTITION not in df.columns or (dates is None and months is None):
        return df
    if months is None:
        months = [r[0] for r in dates.select(F.trunc(F.col(name).cast("date"), "MM")).distinct().collect()]
    return df.where(F.col(MONTH_PARTITION).isin([m for m in months if m is not None]))


def date_spine(spark: SparkSession, start: DateLike, end: DateLike, name: str = "report_date") -> DataFrame:
    """One row per calendar day in ``[start, end]``; the row count is known on the driver."""
    lo, hi = as_date(start), as_date(end)
    n = (hi - lo).days + 1
    if n <= 0:
        return spark.range(0).select(F.lit(lo).alias(name))
    return spark.range(n).select(F.date_add(F.lit(lo), F.col("id").cast("int")).alias(name))


def ledger_span(ledger: DataFrame, name: str = "report_date", col: str = "vrdate") -> DataFrame:
    """Every calendar day from the ledger's first to its last date, derived by Spark.

    A one-row partial aggregate and a generator: nothing reaches the driver,
    and the bounds are computed in the same job as the query that uses the
    spine (a stage running beside the main scan).  AQE sees the spine's
    run-time size — one row per day — and broadcasts it.
    """
    bounds = ledger.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias(name))


def date_text(c: Column) -> Column:
    return F.date_format(c, DATE_TEXT_FORMAT)
