"""A5 — the outbox: one row per message instead of sending mail.

Messages are the availability alerts (one per date, missing material and report
on it) and the sales report of every date whose mail channel decided ``send``.
Each has its subject and the sizes of its report's recipient lists; the
addresses are the rows of :func:`recipient_contacts` with the same ``kind``.
``deliverable`` is false when the report has no "to" address.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerday.functions.dates import date_text
from ledgerday.params import DEFAULT_REPORTS, Report


def _kinds(pairs: list[tuple[Column, Report]]) -> Column:
    kinds = F.array(*[F.when(cond, F.lit(r.kind)) for cond, r in pairs]).cast("array<string>")
    return F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("kind")


def message_outbox(
    alerts: DataFrame,
    decisions: DataFrame,
    recipients: DataFrame,
    reports: tuple[Report, ...] = DEFAULT_REPORTS,
    report_channel: str = "email",
) -> DataFrame:
    """``report_date, kind, report_name, subject, n_to, n_cc, n_bcc, deliverable``.

    ``recipients`` is :func:`report_recipients`: a row per configured report.
    """
    on_material = [(F.col("material") == F.lit(r.material), r) for r in reports if r.material]
    sales = [(F.lit(True), r) for r in reports if not r.material]
    send = decisions.where((F.col("channel") == report_channel) & (F.col("decision") == "send"))
    msgs = alerts.select("report_date", _kinds(on_material)).unionByName(send.select("report_date", _kinds(sales)))
    title = F.coalesce(*[F.when(F.col("kind") == F.lit(r.kind), F.lit(r.subject)) for r in reports])
    return msgs.join(recipients, "kind").select(
        "report_date",
        "kind",
        "report_name",
        F.concat(title, F.lit(" - "), date_text(F.col("report_date"))).alias("subject"),
        "n_to",
        "n_cc",
        "n_bcc",
        "deliverable",
    )
