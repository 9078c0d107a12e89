"""A2 — the report contact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerday.schemas import conform_contacts


def read_contacts(
    spark: SparkSession, path: str, fmt: str = "parquet", options: dict[str, str] | None = None
) -> DataFrame:
    return conform_contacts(spark.read.format(fmt).options(**(options or {})).load(path))


def read_contacts_jdbc(
    spark: SparkSession,
    url: str,
    table: str = "report_contacts",
    properties: dict[str, str] | None = None,
    number: str | None = None,
    bounds: tuple[int, int] | None = None,
    num_partitions: int = 8,
) -> DataFrame:
    """Read the contact table over JDBC: in one query, or by ranges of a numeric column if its bounds are given."""
    options = contacts_jdbc_options(url, table, properties, number, bounds, num_partitions)
    return conform_contacts(spark.read.format("jdbc").options(**options).load())


def contacts_jdbc_options(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    number: str | None = None,
    bounds: tuple[int, int] | None = None,
    num_partitions: int = 8,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """What the JDBC reader is given.  Rows outside the bounds, and nulls, fall into the first and last ranges."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if number is not None and bounds is not None:
        options |= {
            "partitionColumn": number, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]), "numPartitions": str(num_partitions),
        }
    return options | (properties or {})
