"""C10, D2, D3, G1, E7, F2 — report calendar, pending dates and the dates to process."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerday.constants import CHANNELS, DATE_OFFSET, MAX_DAYS_BACK
from ledgerday.functions.dates import DateLike, as_date, date_spine, date_text


def report_calendar(dates: DataFrame, col: str = "report_date") -> DataFrame:
    """ISO date, ``dd/MM/yyyy`` text, month start and two-digit day of month."""
    d = F.col(col)
    return dates.select(
        d.alias("report_date"),
        date_text(d).alias("date_text"),
        F.trunc(d, "MM").alias("month_start"),
        F.date_format(d, "dd").alias("day_of_month"),
    )


def with_channels(dates: DataFrame, channels: tuple[str, ...] = CHANNELS) -> DataFrame:
    """Every date once per channel — a generator over a literal array, not a join."""
    return dates.withColumn("channel", F.explode(F.array(*[F.lit(c) for c in channels])))


def lookback_spine(spark: SparkSession, today: DateLike, max_days_back: int = MAX_DAYS_BACK) -> DataFrame:
    """The ``max_days_back`` dates before ``today`` (today excluded)."""
    t = as_date(today)
    if max_days_back < 1:
        return date_spine(spark, t, t - dt.timedelta(days=1))
    return date_spine(spark, t - dt.timedelta(days=max_days_back), t - dt.timedelta(days=1))


def pending_dates(
    spark: SparkSession,
    log: DataFrame,
    today: DateLike,
    max_days_back: int = MAX_DAYS_BACK,
    channels: tuple[str, ...] = CHANNELS,
) -> DataFrame:
    """(channel, report_date) pairs of the look-back not in the send log."""
    spine = with_channels(lookback_spine(spark, today, max_days_back), channels)
    sent = log.select("channel", F.col("sent_date").alias("report_date"))
    return spine.join(sent, ["channel", "report_date"], "left_anti").select("channel", "report_date")


def dates_to_process(
    spark: SparkSession,
    log: DataFrame,
    today: DateLike,
    max_days_back: int = MAX_DAYS_BACK,
    channels: tuple[str, ...] = CHANNELS,
    date_offset: int = DATE_OFFSET,
) -> DataFrame:
    """Pending dates of any channel plus the target date (even if already sent)."""
    target = as_date(today) - dt.timedelta(days=date_offset)
    pending = pending_dates(spark, log, today, max_days_back, channels).select("report_date")
    target_df = spark.range(1).select(F.lit(target).alias("report_date"))
    return pending.unionByName(target_df).distinct().orderBy("report_date")
