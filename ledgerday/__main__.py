"""Run the daily job: ``spark-submit -m ledgerday`` or ``python -m ledgerday``.

Reads the ledger and the contacts (Parquet folders, or JDBC when a URL is
given), the newest complete version of the send log, works out the dates
due, and writes report rows, outbox and the next log version.  Prints one
JSON line of counts (aggregates only; no data rows reach the driver).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from ledgerday.params import Items, Report, RunOptions
from ledgerday.plans.daily_run import daily_run, run_folder, run_window, write_daily_run
from ledgerday.session import get_session
from ledgerday.sources.contacts import read_contacts, read_contacts_jdbc
from ledgerday.sources.ledger import read_ledger, read_ledger_jdbc
from ledgerday.sources.sendlog import import_log_folder, log_versions, read_latest_send_log


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="ledgerday", description=__doc__.splitlines()[0])
    p.add_argument("--ledger", required=True, help="ledger folder (Parquet) or JDBC table name")
    p.add_argument("--contacts", required=True, help="contacts folder (Parquet) or JDBC table name")
    p.add_argument("--ledger-url", help="JDBC URL of the ledger database")
    p.add_argument("--contacts-url", help="JDBC URL of the contacts database")
    p.add_argument("--log-base", required=True, help="folder of the versioned send log")
    p.add_argument("--import-log-folder", help="start the log store from email_log.json / whatsapp_log.json")
    p.add_argument("--out", required=True, help="output folder of this run")
    p.add_argument("--today", default=dt.date.today().isoformat())
    p.add_argument("--date", action="append", help="process exactly this date (repeatable)")
    p.add_argument("--max-days-back", type=int, default=RunOptions.max_days_back)
    p.add_argument("--retain", type=int, default=RunOptions.retain)
    p.add_argument("--date-offset", type=int, default=RunOptions.date_offset, help="days from the target date to today")
    p.add_argument("--channels", default=",".join(RunOptions.channels), help="comma-separated")
    p.add_argument("--config", help='JSON file: {"items": {...}, "reports": [{...}], "ledger_jdbc": {...}, "contacts_jdbc": {...}}')
    return p.parse_args(argv)


def load_config(path: str | None) -> tuple[Items, tuple[Report, ...], dict, dict]:
    """Items, reports and the JDBC options of both sources from a JSON file; defaults for what it lacks."""
    config = {}
    if path:
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
    unknown = set(config) - {"items", "reports", "ledger_jdbc", "contacts_jdbc"}
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    items = {k: tuple(v) if isinstance(v, list) else v for k, v in config.get("items", {}).items()}
    reports = tuple(Report(**r) for r in config["reports"]) if "reports" in config else RunOptions().reports
    return Items(**items), reports, config.get("ledger_jdbc", {}), config.get("contacts_jdbc", {})


def main(argv=None) -> dict:
    a = parse_args(argv)
    items, reports, ledger_jdbc, contacts_jdbc = load_config(a.config)
    spark = get_session(app_name="ledgerday-daily")
    if a.import_log_folder and not log_versions(spark, a.log_base, complete_only=False):
        import_log_folder(spark, a.import_log_folder, a.log_base)
    opts = RunOptions(
        max_days_back=a.max_days_back, retain=a.retain, date_offset=a.date_offset,
        channels=tuple(c.strip() for c in a.channels.split(",") if c.strip()), reports=reports,
    )
    if a.ledger_url:
        lo, hi = scan_dates(a, opts)
        ledger = read_ledger_jdbc(
            spark, a.ledger_url, a.ledger, properties=ledger_jdbc, date_bounds=(lo, hi), days_per_partition=1
        )
    else:
        ledger = read_ledger(spark, a.ledger)
    contacts = (
        read_contacts_jdbc(spark, a.contacts_url, a.contacts, contacts_jdbc)
        if a.contacts_url
        else read_contacts(spark, a.contacts)
    )
    log = read_latest_send_log(spark, a.log_base)
    run = daily_run(spark, ledger, contacts, log, a.today, items, opts, only_dates=a.date)
    new_log = write_daily_run(run, a.out, a.log_base)
    folder = run_folder(a.out, new_log)
    counts = run.decisions.groupBy("channel", "decision").count().collect()
    # With its schema, as a run without messages leaves a folder without files.
    messages = spark.read.schema(run.outbox.schema).parquet(f"{folder}/outbox").groupBy("kind").count().collect()
    summary = {
        "today": a.today,
        "dates": run.readiness.count(),
        "decisions": {f"{r.channel}:{r.decision}": r["count"] for r in counts},
        "messages": {r.kind: r["count"] for r in messages},
        "out": folder,
        "log": new_log,
    }
    print(json.dumps(summary, default=str))
    return summary


def scan_dates(a: argparse.Namespace, opts: RunOptions) -> tuple[dt.date, dt.date]:
    """The dates between which a run reads the ledger, from the first month's start."""
    given = sorted(dt.date.fromisoformat(d) for d in a.date or ())
    lo, hi = (given[0], given[-1]) if given else run_window(a.today, opts)
    return lo.replace(day=1), hi


if __name__ == "__main__":
    main()
