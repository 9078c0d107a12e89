"""B9, B10, E6 — who receives each report.

One pass over the contact table: each usable row yields one row per report and
role that it holds (``to`` by the report's own flag, ``cc``, ``bcc``).  That long
form is the recipient list, however long: the sender joins it to the outbox by
``kind``.  Lists are keyed by the report's kind, so two reports may share a
report name.  Duplicate addresses are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerday.params import DEFAULT_REPORTS, Report

ROLES = ("to", "cc", "bcc")


def recipient_contacts(contacts: DataFrame, reports: tuple[Report, ...] = DEFAULT_REPORTS) -> DataFrame:
    """Long form ``kind, report_name, role, email``; blanks in report names are significant."""
    usable = F.col("email").isNotNull() & (F.col("email") != F.lit(""))
    rows = contacts.where(F.col("report_name").isin(*[r.report_name for r in reports]) & usable)
    held = [
        F.when(
            (F.col("report_name") == F.lit(r.report_name)) & F.col(flag),
            F.struct(F.lit(r.kind).alias("kind"), F.lit(role).alias("role")),
        )
        for r in reports
        for role, flag in zip(ROLES, (r.to_flag, "is_cc", "is_bcc"))
    ]
    held = F.explode(F.filter(F.array(*held), lambda x: x.isNotNull())).alias("held")
    return rows.select("report_name", held, "email").select("held.kind", "report_name", "held.role", "email")


def report_recipients(contacts: DataFrame, reports: tuple[Report, ...] = DEFAULT_REPORTS) -> DataFrame:
    """``kind, report_name, n_to, n_cc, n_bcc, deliverable``: a row for every configured report.

    The counts are combined map-side; a report whose list has no ``to``
    address can't be delivered.
    """
    rows = recipient_contacts(contacts, reports)
    counts = rows.groupBy("kind").agg(*[F.count_if(F.col("role") == r).alias(f"n_{r}") for r in ROLES])
    names = reduce(
        DataFrame.union,
        [
            contacts.sparkSession.range(1).select(F.lit(r.kind).alias("kind"), F.lit(r.report_name).alias("report_name"))
            for r in reports
        ],
    )
    return names.join(counts, "kind", "left").select(
        "kind",
        "report_name",
        *[F.coalesce(F.col(f"n_{r}"), F.lit(0)).alias(f"n_{r}") for r in ROLES],
        (F.coalesce(F.col("n_to"), F.lit(0)) > 0).alias("deliverable"),
    )
