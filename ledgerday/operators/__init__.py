"""DataFrame operators of the daily report; each takes and returns DataFrames."""

from ledgerday.operators.availability import availability_alerts, availability_rows, report_readiness
from ledgerday.operators.calendar import dates_to_process, lookback_spine, pending_dates, report_calendar, with_channels
from ledgerday.operators.contacts import recipient_contacts, report_recipients
from ledgerday.operators.decisions import send_decisions
from ledgerday.operators.normalise import ledger_normalised
from ledgerday.operators.outbox import message_outbox
from ledgerday.operators.sales import (
    sales_day, sales_mtd, sales_report, sales_report_by_unit, sales_report_text, sales_rows,
)
from ledgerday.operators.sales_multi import daily_sales, sales_report_multi, sales_report_multi_text
from ledgerday.operators.sendlog import send_log_append, send_log_retained

__all__ = [
    "availability_alerts", "availability_rows", "report_readiness",
    "dates_to_process", "lookback_spine", "pending_dates", "report_calendar", "with_channels",
    "recipient_contacts", "report_recipients", "send_decisions", "ledger_normalised", "message_outbox",
    "sales_day", "sales_mtd", "sales_report", "sales_report_by_unit", "sales_report_text", "sales_rows",
    "daily_sales", "sales_report_multi", "sales_report_multi_text", "send_log_append", "send_log_retained",
]
