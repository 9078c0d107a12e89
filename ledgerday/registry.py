"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver's tables through the fixture views
(:mod:`ledgerday.sources.fixtures`) and runs over the whole tables; the only
parameters are the feature's own (a report date, "today" of the daily job,
the log retention).  Decimal columns are returned as DOUBLE so that the
values compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerday.functions.dates import ledger_span
from ledgerday.operators import availability as av
from ledgerday.operators import calendar as cal
from ledgerday.operators import contacts as ct
from ledgerday.operators import decisions as dc
from ledgerday.operators import sales as sl
from ledgerday.operators import sales_multi as sm
from ledgerday.operators import sendlog as lg
from ledgerday.operators.normalise import ledger_normalised
from ledgerday.params import RunOptions
from ledgerday.plans.daily_run import daily_run
from ledgerday.session import scratch_path
from ledgerday.sources import fixtures as fx
from ledgerday.sources.sendlog import read_send_log, write_send_log

ITEMS = fx.FIXTURE_ITEMS
RUN = RunOptions(retain=fx.FIXTURE_RETENTION)

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE (values are exact decimals, so both engines give the same double)."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _ledger(spark: SparkSession, sf: str) -> DataFrame:
    return fx.fixture_ledger(spark, sf)


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return fx.fixture_send_log(spark, sf)


def q_ledger_normalised(spark, sf):
    return plain(ledger_normalised(_ledger(spark, sf), ITEMS))


def q_coal(spark, sf):
    return plain(av.availability_rows(_ledger(spark, sf), "coal", items=ITEMS))


def q_maize(spark, sf):
    return plain(av.availability_rows(_ledger(spark, sf), "maize", items=ITEMS))


def q_ethanol(spark, sf):
    return plain(av.availability_rows(_ledger(spark, sf), "ethanol", items=ITEMS))


def q_readiness(spark, sf):
    return av.report_readiness(_ledger(spark, sf), items=ITEMS)


def q_alerts(spark, sf):
    return av.availability_alerts(av.report_readiness(_ledger(spark, sf), items=ITEMS))


def q_sales_rows(spark, sf):
    return plain(sl.sales_rows(_ledger(spark, sf), ITEMS))


def q_sales_day(spark, sf):
    return plain(sl.sales_day(_ledger(spark, sf), fx.REPORT_DATE, ITEMS))


def q_sales_mtd(spark, sf):
    return plain(sl.sales_mtd(_ledger(spark, sf), fx.REPORT_DATE, items=ITEMS))


def q_sales_report(spark, sf):
    return plain(sl.sales_report(_ledger(spark, sf), fx.REPORT_DATE, items=ITEMS))


def q_sales_report_by_unit(spark, sf):
    return plain(sl.sales_report_by_unit(_ledger(spark, sf), fx.REPORT_DATE, items=ITEMS))


def q_sales_report_text(spark, sf):
    return sl.sales_report_text(_ledger(spark, sf), fx.REPORT_DATE, items=ITEMS)


def q_sales_report_multi(spark, sf):
    ledger = _ledger(spark, sf)
    return plain(sm.sales_report_multi(ledger, ledger_span(ledger), ITEMS))


def q_sales_report_multi_text(spark, sf):
    ledger = _ledger(spark, sf)
    return sm.sales_report_multi_text(ledger, ledger_span(ledger), ITEMS)


def q_report_calendar(spark, sf):
    dates = _ledger(spark, sf).select(F.col("vrdate").alias("report_date")).distinct()
    return cal.report_calendar(dates)


def q_pending_dates(spark, sf):
    return cal.pending_dates(spark, _log(spark, sf), fx.TODAY, RUN.max_days_back, RUN.channels)


def q_dates_to_process(spark, sf):
    return cal.dates_to_process(spark, _log(spark, sf), fx.TODAY, RUN.max_days_back, RUN.channels, RUN.date_offset)


def q_send_decisions(spark, sf):
    readiness = av.report_readiness(_ledger(spark, sf), items=ITEMS)
    return dc.send_decisions(readiness, _log(spark, sf), RUN.channels)


def q_send_log_read(spark, sf):
    path = scratch_path(spark, "send-log")
    write_send_log(_log(spark, sf), path)
    return read_send_log(spark, path)


def q_send_log_retained(spark, sf):
    return lg.send_log_retained(_log(spark, sf), RUN.retain)


def _run(spark, sf):
    return daily_run(
        spark, _ledger(spark, sf), fx.fixture_contacts(spark, sf), _log(spark, sf), fx.TODAY, ITEMS, RUN
    )


def q_send_log_append(spark, sf):
    return _run(spark, sf).log_rows


def q_message_outbox(spark, sf):
    return _run(spark, sf).outbox


def q_daily_run_decisions(spark, sf):
    return _run(spark, sf).decisions


def q_daily_run_reports(spark, sf):
    return plain(_run(spark, sf).reports)


def q_recipient_contacts(spark, sf):
    return ct.recipient_contacts(fx.fixture_contacts(spark, sf), RUN.reports)


def q_report_recipients(spark, sf):
    return ct.report_recipients(fx.fixture_contacts(spark, sf), RUN.reports)


QUERIES: dict[str, Query] = {
    "ledger_normalised": q_ledger_normalised,
    "coal_availability": q_coal,
    "maize_availability": q_maize,
    "ethanol_receipts": q_ethanol,
    "report_readiness": q_readiness,
    "availability_alerts": q_alerts,
    "sales_rows": q_sales_rows,
    "sales_day": q_sales_day,
    "sales_mtd": q_sales_mtd,
    "sales_report": q_sales_report,
    "sales_report_by_unit": q_sales_report_by_unit,
    "sales_report_text": q_sales_report_text,
    "sales_report_multi": q_sales_report_multi,
    "report_calendar": q_report_calendar,
    "pending_dates": q_pending_dates,
    "dates_to_process": q_dates_to_process,
    "send_decisions": q_send_decisions,
    "send_log_read": q_send_log_read,
    "send_log_append": q_send_log_append,
    "send_log_retained": q_send_log_retained,
    "report_recipients": q_report_recipients,
    "message_outbox": q_message_outbox,
    "recipient_contacts": q_recipient_contacts,
    # The daily job's own outputs and the text form of the multi-date report.
    "sales_report_multi_text": q_sales_report_multi_text,
    "daily_run_decisions": q_daily_run_decisions,
    "daily_run_reports": q_daily_run_reports,
}
