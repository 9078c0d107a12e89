"""A1 — the goods-movement ledger: read (Parquet / any file format / JDBC) and store."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerday.functions.dates import DateLike, as_date
from ledgerday.schemas import MONTH_PARTITION, conform_ledger


def read_ledger(
    spark: SparkSession, path: str, fmt: str = "parquet", options: dict[str, str] | None = None
) -> DataFrame:
    """Read a ledger table and cast it to the ledger schema.

    Reading a folder written by :func:`write_ledger` also yields the month
    partition column, which the date filters of every operator use for
    partition pruning.
    """
    return conform_ledger(spark.read.format(fmt).options(**(options or {})).load(path))


def read_ledger_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    properties: dict[str, str] | None = None,
    date_bounds: tuple[DateLike, DateLike] | None = None,
    num_partitions: int | None = None,
    days_per_partition: int = 7,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Read the ledger view over JDBC, split into parallel range reads on ``vrdate``.

    Connection details come from the caller.  Unsized NUMBER columns arrive as
    DECIMAL(38,10) and DATE as TIMESTAMP, so the result is cast to the ledger
    schema; filters applied later are still pushed into the remote query.
    """
    options = jdbc_options(
        url, table, properties=properties, date_bounds=date_bounds, num_partitions=num_partitions,
        days_per_partition=days_per_partition, fetch_size=fetch_size,
    )
    return conform_ledger(spark.read.format("jdbc").options(**options).load())


def jdbc_options(
    url: str,
    table: str,
    *,
    properties: dict[str, str] | None = None,
    date_bounds: tuple[DateLike, DateLike] | None = None,
    num_partitions: int | None = None,
    days_per_partition: int = 7,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """What the JDBC reader is given; with ``date_bounds`` one range of days on ``vrdate`` per partition.

    The bounds only cut the ranges: the first and last ones are open, so lines outside them, and
    lines without a date, are read as well.  The caller's ``properties`` win.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if date_bounds is not None:
        lo, hi = (as_date(d) for d in date_bounds)
        if hi < lo:
            raise ValueError(f"date bounds {lo} to {hi}")
        parts = num_partitions or max(1, (hi - lo).days // days_per_partition + 1)
        # The upper bound is exclusive when ranges are cut: the day after the last one.
        options |= {
            "partitionColumn": "vrdate",
            "lowerBound": lo.isoformat(),
            "upperBound": (hi + dt.timedelta(days=1)).isoformat(),
            "numPartitions": str(min(parts, (hi - lo).days + 1)),
        }
    return options | (properties or {})


def write_ledger(ledger: DataFrame, path: str, mode: str = "errorifexists", partitions: int | None = None) -> None:
    """Store the ledger by month, each file sorted by date.

    The source is read once: lines are rebalanced by month, and adaptive
    execution cuts a busy month - even one day or voucher that holds a third of
    all lines - into parts of the advisory partition size and joins small
    months' parts.  Sorting by date inside each task keeps Parquet row-group
    statistics tight for the single-day predicates.
    """
    out = ledger.withColumn(MONTH_PARTITION, F.trunc("vrdate", "MM"))
    by_month = [partitions, F.col(MONTH_PARTITION)] if partitions else [F.col(MONTH_PARTITION)]
    out = out.hint("rebalance", *by_month).sortWithinPartitions(MONTH_PARTITION, "vrdate", "vrno")
    out.write.mode(mode).partitionBy(MONTH_PARTITION).parquet(path)
