"""Hand-made rows for availability, readiness, alerts and decisions."""

from __future__ import annotations

from ledger_helpers import D

from ledgerday.constants import COAL_ITEM, ETHANOL_ITEM, MAIZE_ITEM
from ledgerday.operators import availability as A
from ledgerday.operators.decisions import send_decisions


def _ledger(ledger_of):
    q = dict(tcode="Q", vrdate="2024-03-05")
    return ledger_of(
        [
            dict(q, item_name=COAL_ITEM, qtyissued=5000, um="KGS"),
            dict(q, item_name=COAL_ITEM, qtyissued=0, um="KGS"),
            dict(q, item_name=COAL_ITEM.lower(), qtyissued=9, um="KGS"),
            dict(q, item_name=MAIZE_ITEM, qtyissued=3, um="kgs"),
            dict(q, item_name=ETHANOL_ITEM, qtyrecd=2000, um="KGS"),
            dict(q, item_name=ETHANOL_ITEM.lower(), qtyrecd=10, um="KGS"),
            dict(q, item_name=MAIZE_ITEM, qtyissued=3, um="LTR", vrdate="2024-03-06"),
            dict(item_name=COAL_ITEM, qtyissued=3, vrdate="2024-03-06", tcode="S"),
        ]
    )


def test_rows_and_unit_conversion(ledger_of):
    led = _ledger(ledger_of)
    coal = A.availability_rows(led, "coal", "2024-03-05").collect()
    assert [(r.item_name, r.qty_issued) for r in coal] == [(COAL_ITEM, 5.0)]
    maize = A.availability_rows(led, "maize").collect()
    assert sorted((r.vrdate, r.qty_issued) for r in maize) == [(D("2024-03-05"), 3.0), (D("2024-03-06"), 3.0)]
    eth = A.availability_rows(led, "ethanol", "2024-03-05").collect()
    # A lower-case ethanol name is not an ethanol receipt (exact comparison).
    assert [(r.item_name, r.qty_received) for r in eth] == [("ETHANOL", 2.0)]


def test_readiness_alerts_and_empty_dates(spark, ledger_of):
    led = _ledger(ledger_of)
    dates = spark.createDataFrame([(D(d),) for d in ("2024-03-05", "2024-03-06", "2024-03-07")], "report_date date")
    ready = {r.report_date: tuple(r)[1:] for r in A.report_readiness(led, dates).collect()}
    assert ready == {
        D("2024-03-05"): (1, 1, 1, True),
        D("2024-03-06"): (0, 1, 0, False),
        D("2024-03-07"): (0, 0, 0, False),
    }
    alerts = sorted(tuple(r) for r in A.availability_alerts(A.report_readiness(led, dates)).collect())
    assert alerts == [(D("2024-03-06"), "coal"), (D("2024-03-07"), "coal"), (D("2024-03-07"), "maize")]


def test_every_day_of_the_calendar_is_judged(ledger_of):
    # 7 March has only a sale, 8 March nothing, 9 March a sale.
    sales = [dict(vrdate=f"2024-03-0{d}", item_name="X", tcode="S") for d in (7, 9)]
    led = ledger_of(sales).unionByName(_ledger(ledger_of))
    ready = A.report_readiness(led)
    days = {r.report_date: tuple(r)[1:] for r in ready.collect()}
    assert days == {D("2024-03-05"): (1, 1, 1, True), D("2024-03-06"): (0, 1, 0, False)} | {
        D(f"2024-03-0{d}"): (0, 0, 0, False) for d in (7, 8, 9)}
    alerts = {tuple(r) for r in A.availability_alerts(ready).collect()}
    assert {(D("2024-03-08"), m) for m in ("coal", "maize")} <= alerts and len(alerts) == 7
    assert A.report_readiness(led.limit(0)).count() == 0


def test_decisions_unready_wins(spark, ledger_of, log_of):
    led = _ledger(ledger_of)
    dates = spark.createDataFrame([(D("2024-03-05"),), (D("2024-03-06"),)], "report_date date")
    log = log_of([("email", "2024-03-05", 0), ("email", "2024-03-06", 1)])
    got = {(r.report_date, r.channel): r.decision for r in send_decisions(A.report_readiness(led, dates), log).collect()}
    assert got == {
        (D("2024-03-05"), "email"): "already_sent",
        (D("2024-03-05"), "whatsapp"): "send",
        (D("2024-03-06"), "email"): "not_ready",
        (D("2024-03-06"), "whatsapp"): "not_ready",
    }
