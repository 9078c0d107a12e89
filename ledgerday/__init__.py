"""ledgerday — daily operational reporting over a goods-movement ledger, on Spark.

Typical use::

    from ledgerday import get_session, read_ledger, read_contacts, read_latest_send_log
    from ledgerday import daily_run, write_daily_run, write_next_send_log

    spark = get_session()
    run = daily_run(spark, read_ledger(spark, ledger_path), read_contacts(spark, contacts_path),
                    read_latest_send_log(spark, log_base), today)
    write_daily_run(run, out_dir, new_log_path)
"""

from ledgerday.params import DEFAULT_ITEMS, DEFAULT_REPORTS, Items, Report, RunOptions
from ledgerday.plans.daily_run import DailyRun, daily_run, write_daily_run
from ledgerday.session import get_session, scratch_dir, scratch_path
from ledgerday.sources import (
    read_contacts, read_contacts_jdbc, read_latest_send_log, read_ledger, read_ledger_jdbc, read_send_log,
    write_ledger, write_next_send_log, write_send_log,
)

__all__ = [
    "DEFAULT_ITEMS", "DEFAULT_REPORTS", "Items", "Report", "RunOptions",
    "DailyRun", "daily_run", "write_daily_run",
    "get_session", "scratch_dir", "scratch_path",
    "read_contacts", "read_contacts_jdbc", "read_latest_send_log", "read_ledger", "read_ledger_jdbc",
    "read_send_log", "write_ledger", "write_next_send_log", "write_send_log",
]
