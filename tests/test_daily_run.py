"""The daily job end to end: outputs, write order, and a second run over the new log."""

from __future__ import annotations

import importlib
from collections import Counter

import pytest
from ledger_helpers import SF_CHECK, D

from plan_inspect import scan_count

from ledgerday.params import Items, RunOptions
from ledgerday.plans.daily_run import daily_run, is_committed, read_run, write_daily_run
from ledgerday.session import scratch_path
from ledgerday.sources.fixtures import FIXTURE_ITEMS, fixture_contacts, fixture_ledger, fixture_send_log
from ledgerday.sources.sendlog import read_latest_send_log


def test_daily_run_and_rerun(spark):
    ledger = fixture_ledger(spark, SF_CHECK)
    contacts = fixture_contacts(spark, SF_CHECK)
    log = fixture_send_log(spark, SF_CHECK)
    opts = RunOptions(retain=10)
    run = daily_run(spark, ledger, contacts, log, "1998-03-20", FIXTURE_ITEMS, opts)

    dates = [r.report_date for r in run.dates.collect()]
    assert dates == sorted(dates) and D("1998-03-19") in dates
    decisions = Counter((r.channel, r.decision) for r in run.decisions.collect())
    sends = [r.report_date for r in run.decisions.where("channel = 'email' AND decision = 'send'").collect()]
    assert sum(decisions.values()) == 2 * len(dates)
    # One monthly message per email 'send', one alert per missing coal / maize.
    kinds = Counter(r.kind for r in run.outbox.collect())
    assert kinds["monthly_report"] == len(sends)
    assert kinds["coal_availability"] == run.readiness.where("coal_rows = 0").count()
    # The report rows cover exactly the dates to send, and the text has a line for each of them.
    assert {r.report_date for r in run.reports.select("report_date").distinct().collect()} == set(sends)
    lines = run.report_text.collect()
    assert len(lines) == run.reports.count() and {r.kind for r in lines} == {"monthly_report"}
    for d in sends:
        own = sorted((r for r in lines if r.report_date == d), key=lambda r: r.line_no)
        assert [r.line_no for r in own] == list(range(1, len(own) + 1))
        assert [r.product_name for r in own] == sorted(r.product_name for r in own)

    out, log_base = scratch_path(spark, "run"), scratch_path(spark, "log")
    assert write_daily_run(run, out, log_base).endswith("v=0")
    assert spark.read.parquet(f"{out}/run=0/outbox").count() == run.outbox.count()
    assert spark.read.parquet(f"{out}/run=0/addresses").count() == run.addresses.count()
    new_log = read_latest_send_log(spark, log_base)
    sizes = {r.channel: r["count"] for r in new_log.groupBy("channel").count().collect()}
    before = {r.channel: r["count"] for r in log.groupBy("channel").count().collect()}
    grew = {r.channel for r in run.decisions.where("decision = 'send'").collect()}
    assert grew and all(sizes[c] <= 10 for c in grew)
    assert all(sizes[c] == before[c] for c in before if c not in grew)

    # Second run on the new log: nothing decided 'send' before is sent again.
    again = daily_run(spark, ledger, contacts, new_log, "1998-03-20", FIXTURE_ITEMS, opts)
    resend = again.decisions.where("decision = 'send'").join(
        run.decisions.where("decision = 'send'"), ["report_date", "channel"], "left_semi"
    )
    assert resend.count() == 0


def test_command_line_job(spark, tmp_path):
    import json as _json

    from ledgerday.__main__ import main
    from ledgerday.sources.ledger import write_ledger

    ledger_dir, contacts_dir = scratch_path(spark, "cli-ledger"), scratch_path(spark, "cli-contacts")
    write_ledger(fixture_ledger(spark, SF_CHECK), ledger_dir)
    fixture_contacts(spark, SF_CHECK).write.parquet(contacts_dir)
    folder = tmp_path / "logs"
    folder.mkdir()
    sent = ["1998-03-14", "1998-03-13"]
    (folder / "email_log.json").write_text(_json.dumps({"sentDates": sent}, indent=2))
    log_base, out = scratch_path(spark, "cli-log"), scratch_path(spark, "cli-out")
    config = tmp_path / "config.json"
    config.write_text(_json.dumps({"items": {"coal": FIXTURE_ITEMS.coal, "maize": FIXTURE_ITEMS.maize,
                                             "ethanol": FIXTURE_ITEMS.ethanol, "scrap": list(FIXTURE_ITEMS.scrap)}}))
    args = ["--config", str(config), "--max-days-back", "40", "--ledger", ledger_dir, "--contacts", contacts_dir, "--log-base", log_base, "--out", out,
            "--import-log-folder", str(folder), "--today", "1998-03-20", "--retain", "10"]
    summary = main(args)
    assert summary["dates"] >= 1 and summary["log"].endswith("v=1") and summary["out"].endswith("run=1")
    first = {n: sorted(spark.read.parquet(f"{out}/run=1/{n}").collect(), key=str) for n in ("outbox", "report_text", "reports")}
    assert any(r.kind == "monthly_report" for r in first["outbox"]) and first["report_text"]
    only_given = ["--date", "1998-03-05", "--today", "1998-03-20", "--channels", "email", "--date-offset", "2"]
    # The same command again: what the first run has to send is still there, and nothing of it is sent twice.
    again = main(args)
    assert again["out"].endswith("run=2") and "monthly_report" not in again["messages"]
    assert first == {n: sorted(spark.read.parquet(f"{out}/run=1/{n}").collect(), key=str) for n in first}
    # One-date mode, as for a single report date.
    one = main(args[:-6] + only_given)
    assert one["dates"] == 1 and all(k.startswith("email:") for k in one["decisions"])


def test_a_run_killed_before_its_log_repeats(spark, monkeypatch):
    module = importlib.import_module("ledgerday.plans.daily_run")

    args = (spark, fixture_ledger(spark, SF_CHECK), fixture_contacts(spark, SF_CHECK), fixture_send_log(spark, SF_CHECK))
    opts = RunOptions(retain=10)
    out, log_base = scratch_path(spark, "killed"), scratch_path(spark, "killed-log")

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(module, "write_next_send_log", die)
        with pytest.raises(RuntimeError):
            write_daily_run(daily_run(*args, "1998-03-20", FIXTURE_ITEMS, opts), out, log_base)
    assert not is_committed(spark, f"{out}/run=0")
    with pytest.raises(ValueError, match="committed"):
        read_run(spark, out, f"{log_base}/v=0", "outbox")
    run = daily_run(*args, "1998-03-20", FIXTURE_ITEMS, opts)
    assert write_daily_run(run, out, log_base).endswith("v=0")
    assert spark.read.parquet(f"{out}/run=0/outbox").count() == run.outbox.count()
    # Nothing is written behind the log's version, so a run killed from then on is a committed one.
    assert is_committed(spark, f"{out}/run=0")
    assert sorted(read_run(spark, out, f"{log_base}/v=0", "addresses").collect()) == sorted(run.addresses.select(*read_run(spark, out, f"{log_base}/v=0", "addresses").columns).collect())
    # Another log that would commit its version 0 into the same folder is refused.
    with pytest.raises(ValueError, match="committed"):
        write_daily_run(run, out, scratch_path(spark, "other-log"))


def test_rows_and_text_of_a_run_read_the_ledger_once(spark):
    ledger = fixture_ledger(spark, SF_CHECK)
    run = daily_run(spark, ledger, fixture_contacts(spark, SF_CHECK), fixture_send_log(spark, SF_CHECK), "1998-03-20", FIXTURE_ITEMS)
    assert scan_count(run.reports, "lineitem.parquet") == scan_count(run.report_text, "lineitem.parquet") == 0
    lazy = daily_run(spark, ledger, fixture_contacts(spark, SF_CHECK), fixture_send_log(spark, SF_CHECK), "1998-03-20", FIXTURE_ITEMS, checkpoint=False)
    assert sorted(run.reports.collect(), key=str) == sorted(lazy.reports.collect(), key=str)
    assert sorted(run.report_text.collect(), key=str) == sorted(lazy.report_text.collect(), key=str)


def test_config_file(tmp_path):
    from ledgerday.__main__ import load_config, parse_args, scan_dates

    path = tmp_path / "config.json"
    path.write_text('{"items": {"coal": "C", "scrap": ["S"]}, "ledger_jdbc": {"user": "u", "driver": "d"}, "reports": '
                    '[{"kind": "k", "report_name": "n", "to_flag": "is_cc", "subject": "s"}]}')
    items, reports, ledger, contacts = load_config(str(path))
    assert (items.coal, items.scrap, reports[0].kind, ledger["user"], contacts) == ("C", ("S",), "k", "u", {})
    assert load_config(None) == (Items(), RunOptions().reports, {}, {})
    path.write_text('{"item": {}}')
    with pytest.raises(ValueError):
        load_config(str(path))
    base = ["--ledger", "l", "--contacts", "c", "--log-base", "b", "--out", "o", "--today", "2024-03-02"]
    assert scan_dates(parse_args(base), RunOptions()) == (D("2024-02-01"), D("2024-03-01"))
    assert scan_dates(parse_args([*base, "--date", "2024-01-09"]), RunOptions()) == (D("2024-01-01"), D("2024-01-09"))
