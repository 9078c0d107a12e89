"""The send log: file formats, bad files, append, retention, pending dates."""

from __future__ import annotations

import json
import os
import tempfile

from ledger_helpers import D

from ledgerday.operators.calendar import dates_to_process, pending_dates
from ledgerday.operators.sendlog import send_log_append, send_log_retained
from ledgerday.session import scratch_path
from ledgerday.sources.sendlog import read_send_log, write_send_log


def _file(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_reference_layout_and_bad_files(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    email = _file(folder, "email_log.json", json.dumps({"sentDates": ["2024-03-01", "not-a-date", "2024-03-03"]}, indent=2))
    corrupt = _file(folder, "corrupt.json", '{"sentDates": [')
    fieldless = _file(folder, "fieldless.json", '{"other": 1}')
    got = read_send_log(spark, {"email": email, "whatsapp": os.path.join(folder, "missing.json")}).collect()
    assert sorted(tuple(r) for r in got) == [("email", D("2024-03-01"), 0), ("email", D("2024-03-03"), 2)]
    assert read_send_log(spark, {"a": corrupt, "b": fieldless}).count() == 0
    assert read_send_log(spark, os.path.join(folder, "no-such-folder")).count() == 0


def test_write_read_round_trip(spark, log_of):
    log = log_of([("email", "2024-03-02", 7), ("email", "2024-03-01", 9), ("whatsapp", "2024-03-05", 3)])
    path = scratch_path(spark, "log")
    write_send_log(log, path)
    docs = [json.loads(line) for p, _, fs in os.walk(path.replace("file:", "")) for f in fs if f.endswith(".json")
            for line in open(os.path.join(p, f))]
    assert sorted(d["sentDates"] for d in docs) == [["2024-03-02", "2024-03-01"], ["2024-03-05"]]
    back = sorted(tuple(r) for r in read_send_log(spark, path).collect())
    assert back == [("email", D("2024-03-01"), 1), ("email", D("2024-03-02"), 0), ("whatsapp", D("2024-03-05"), 0)]


def test_append_skips_logged_dates_and_is_idempotent(spark, log_of):
    log = log_of([("email", "2024-03-01", 0), ("email", "2024-03-02", 1)])
    new = spark.createDataFrame(
        [("email", D("2024-03-02")), ("email", D("2024-03-03")), ("whatsapp", D("2024-03-03"))], "channel string, sent_date date"
    )
    once = send_log_append(log, new, retain=30)
    assert sorted(tuple(r) for r in once.collect()) == [
        ("email", D("2024-03-01"), 0), ("email", D("2024-03-02"), 1), ("email", D("2024-03-03"), 2),
        ("whatsapp", D("2024-03-03"), 0),
    ]
    twice = send_log_append(once, new, retain=30)
    assert sorted(tuple(r) for r in twice.collect()) == sorted(tuple(r) for r in once.collect())


def test_retention_keeps_last_by_insertion_order(spark, log_of):
    # Inserted newest date first: the last five inserted are the five oldest dates.
    rows = [("email", f"2024-01-{i + 1:02d}", 34 - i) for i in range(31)]
    log = log_of(rows + [("whatsapp", "2024-02-01", 0)])
    kept = send_log_retained(log, 5).collect()
    assert sorted(r.sent_date for r in kept if r.channel == "email") == [D(f"2024-01-0{d}") for d in range(1, 6)]
    assert [r.seq for r in kept if r.channel == "whatsapp"] == [0]


def test_append_trims_only_channels_that_grew(spark, log_of):
    email = [("email", f"2023-{m:02d}-{d:02d}", (m - 1) * 28 + d) for m in (1, 2) for d in range(1, 19)]  # 36 rows
    whats = [("whatsapp", f"2023-{m:02d}-{d:02d}", (m - 1) * 28 + d) for m in (1, 2) for d in range(1, 19)]
    log = log_of(email + whats)
    new = spark.createDataFrame([("email", D("2024-03-01"))], "channel string, sent_date date")
    out = send_log_append(log, new, retain=30).collect()
    em = [r for r in out if r.channel == "email"]
    assert len(em) == 30 and max(em, key=lambda r: r.seq).sent_date == D("2024-03-01")
    assert len([r for r in out if r.channel == "whatsapp"]) == 36


def test_pending_and_dates_to_process(spark, log_of):
    log = log_of([("email", "2024-03-09", 0), ("email", "2024-03-07", 1)])
    pend = sorted(tuple(r) for r in pending_dates(spark, log, "2024-03-10", 3).collect())
    assert pend == [
        ("email", D("2024-03-08")),
        ("whatsapp", D("2024-03-07")), ("whatsapp", D("2024-03-08")), ("whatsapp", D("2024-03-09")),
    ]
    due = [r.report_date for r in dates_to_process(spark, log, "2024-03-10", 3).collect()]
    assert due == [D("2024-03-07"), D("2024-03-08"), D("2024-03-09")]
    full = log_of([(c, f"2024-03-0{d}", d) for c in ("email", "whatsapp") for d in (7, 8, 9)])
    # The target date is processed even when every channel has sent it.
    assert [r.report_date for r in dates_to_process(spark, full, "2024-03-10", 3).collect()] == [D("2024-03-09")]


def test_versioned_store_skips_incomplete_versions(spark, log_of):
    from ledgerday.sources.sendlog import log_versions, read_latest_send_log, write_next_send_log

    base = scratch_path(spark, "logstore")
    assert read_latest_send_log(spark, base).count() == 0
    write_next_send_log(spark, log_of([("email", "2024-03-01", 0)]), base)
    write_next_send_log(spark, log_of([("email", "2024-03-01", 0), ("email", "2024-03-02", 1)]), base)
    os.makedirs(base.replace("file:", "") + "/v=2")  # a run that died before committing
    assert log_versions(spark, base) == [0, 1]
    assert read_latest_send_log(spark, base).count() == 2
    assert write_next_send_log(spark, log_of([("email", "2024-03-03", 0)]), base).endswith("v=3")
    assert [r.sent_date for r in read_latest_send_log(spark, base).collect()] == [D("2024-03-03")]
