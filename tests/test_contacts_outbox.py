"""Recipients (blanks in report names, empty roles, duplicates, shared names) and the outbox."""

from __future__ import annotations

from collections import Counter
from dataclasses import replace

from ledger_helpers import SF_CHECK, D

from ledgerday.operators.contacts import recipient_contacts, report_recipients
from ledgerday.operators.outbox import message_outbox
from ledgerday.params import DEFAULT_REPORTS
from ledgerday.sources.fixtures import fixture_contacts
from plan_inspect import physical_plan

COAL, MAIZE, MONTHLY = "Coal Availability (Email) ", "Maize Availability (Email)", "MIS Email Monthly"


def _contacts(contacts_of):
    return contacts_of(
        [
            (COAL, "a@x", True, False, False, False, False),
            (COAL, "b@x", False, False, False, True, False),
            (COAL.strip(), "c@x", True, False, False, False, False),
            (COAL, "d@x", False, True, False, False, False),
            (MAIZE, "", False, True, False, False, False),
            (MAIZE, None, False, True, False, False, False),
            (MAIZE, "m@x", False, False, False, False, True),
            (MONTHLY, "z@x", False, False, True, True, True),
            (MONTHLY, "y@x", False, False, True, False, False),
            (MONTHLY, "y@x", False, False, True, False, False),
        ]
    )


def _lists(contacts, reports=DEFAULT_REPORTS):
    return Counter((r.kind, r.role, r.email) for r in recipient_contacts(contacts, reports).collect())


def test_recipients(contacts_of):
    assert _lists(_contacts(contacts_of)) == {
        ("coal_availability", "to", "a@x"): 1, ("coal_availability", "cc", "b@x"): 1, ("maize_availability", "bcc", "m@x"): 1,
        ("monthly_report", "to", "z@x"): 1, ("monthly_report", "cc", "z@x"): 1, ("monthly_report", "bcc", "z@x"): 1,
        ("monthly_report", "to", "y@x"): 2,
    }
    rows = report_recipients(_contacts(contacts_of)).collect()
    assert {tuple(r) for r in rows} == {
        ("coal_availability", COAL, 1, 1, 0, True),
        ("maize_availability", MAIZE, 0, 0, 1, False),
        ("monthly_report", MONTHLY, 3, 1, 1, True),
    }
    assert {tuple(r)[2:] for r in report_recipients(contacts_of([])).collect()} == {(0, 0, 0, False)}


def test_a_long_list_stays_whole(contacts_of):
    rows = [(MONTHLY, f"u{i:04d}@x", False, False, True, False, False) for i in range(2000)]
    rows += [(MONTHLY, "hot@x", False, False, True, False, False)] * 1000
    contacts = contacts_of(rows)
    assert sum(_lists(contacts).values()) == 3000
    assert [r.n_to for r in report_recipients(contacts).collect() if r.kind == "monthly_report"] == [3000]


def test_outbox_has_one_row_a_message(spark, contacts_of):
    alerts = spark.createDataFrame([(D("2024-03-06"), "maize"), (D("2024-03-06"), "coal")], "report_date date, material string")
    decisions = spark.createDataFrame(
        [(D("2024-03-05"), "email", "send"), (D("2024-03-05"), "whatsapp", "send"), (D("2024-03-06"), "email", "not_ready")],
        "report_date date, channel string, decision string",
    )
    out = message_outbox(alerts, decisions, report_recipients(_contacts(contacts_of)))
    got = {(r.report_date, r.kind): (r.report_name, r.n_to, r.subject, r.deliverable) for r in out.collect()}
    assert out.count() == 3 and got == {
        (D("2024-03-06"), "maize_availability"): (MAIZE, 0, "Production Details Not Available - 06/03/2024", False),
        (D("2024-03-06"), "coal_availability"): (COAL, 1, "Power Plant Data Not Available - 06/03/2024", True),
        (D("2024-03-05"), "monthly_report"): (MONTHLY, 3, "Daily MIS Report - 05/03/2024", True),
    }


def test_reports_may_share_a_name_and_a_material(spark, contacts_of):
    coal, maize, monthly = DEFAULT_REPORTS
    second = replace(coal, kind="coal_copy", subject="Copy")
    shared = replace(maize, kind="maize_shared", report_name=COAL)
    reports = (coal, second, shared, monthly)
    lists = _lists(_contacts(contacts_of), reports)
    assert lists["coal_copy", "to", "a@x"] == lists["coal_availability", "to", "a@x"] == 1
    assert lists["maize_shared", "to", "d@x"] == 1 and lists["maize_shared", "to", "a@x"] == 0
    alerts = spark.createDataFrame([(D("2024-03-06"), "coal"), (D("2024-03-06"), "maize")], "report_date date, material string")
    none = spark.createDataFrame([], "report_date date, channel string, decision string")
    out = message_outbox(alerts, none, report_recipients(_contacts(contacts_of), reports), reports).collect()
    assert {r.kind: r.n_to for r in out} == {"coal_availability": 1, "coal_copy": 1, "maize_shared": 1} and len(out) == 3


def test_recipient_lists_need_no_shuffle(spark):
    plan = physical_plan(recipient_contacts(fixture_contacts(spark, SF_CHECK)))
    assert "Exchange" not in plan and "Sort" not in plan and "Join" not in plan
