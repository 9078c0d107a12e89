"""Hand-made rows for the sales report: NULL logic, units, text rules, fan-out, rounding, dates."""

from __future__ import annotations

from decimal import Decimal

from ledger_helpers import D
from pyspark.sql import functions as F

from ledgerday.functions.numtext import number_text
from ledgerday.operators import sales as S
from ledgerday.operators.calendar import report_calendar
from ledgerday.constants import ETHANOL_ITEM


def test_number_text(spark):
    vals = ["12.50", "12.00", "0.50", "100.00", "-0.25", "0.00", "7.000", "0.125"]
    df = spark.createDataFrame([(Decimal(v),) for v in vals], "v decimal(10,3)")
    got = [r[0] for r in df.select(number_text(F.col("v"))).collect()]
    assert got == ["12.5", "12", ".5", "100", "-.25", "0", "7", ".125"]


def test_exclusions_drop_nulls_and_empty_strings(ledger_of):
    base = dict(vrdate="2024-03-05", aqtyissued=1000)
    rows = [
        dict(base, item_name="A"),
        dict(base, item_name="A", item_nature=None),
        dict(base, item_name="A", item_nature="SR"),
        dict(base, item_name="A", acc_name=None),
        dict(base, item_name="A", acc_name="CANCEL PARTY"),
        dict(base, item_name=" commercial scrap "),
        dict(base, item_name="SCRAP EMPTY GUNNY BAGS"),
        dict(base, item_name=None),
        dict(base, item_name="A", tcode="Q"),
        dict(base, item_name=" A "),
        dict(base, item_name=""),
        dict(base, item_name="   "),
        dict(base, item_name="A", item_nature=""),
        dict(base, item_name="A", acc_name=""),
    ]
    got = sorted(r.product_name for r in S.sales_rows(ledger_of(rows)).collect())
    assert got == [" A ", "A"]


def _units_ledger(ledger_of):
    day = "2024-03-05"
    return ledger_of(
        [
            dict(vrdate=day, item_name="B", aum="kgs", aqtyissued=1500, vrno=10),
            dict(vrdate=day, item_name="C", aum="LTR", aqtyissued=12.5, vrno=11),
            dict(vrdate=day, item_name="E", aum=None, aqtyissued=7, vrno=12),
            dict(vrdate=day, item_name="F", aum="KGS", aqtyissued=None, vrno=None),
            dict(vrdate="2024-03-02", item_name="G", aum="KGS", aqtyissued=250, vrno=13),
            dict(vrdate="2024-02-29", item_name="G", aum="KGS", aqtyissued=999, vrno=14),
        ]
    )


def test_report_text_units_and_nulls(ledger_of):
    got = {tuple(r) for r in S.sales_report_text(_units_ledger(ledger_of), "2024-03-05").collect()}
    assert got == {
        ("B", "1.5 MT", "1", "1.5 MT/ .3 MT", "1/ 0"),
        ("C", "12.5 LTR", "1", "12.5 LTR/ 2.5 LTR", "1/ 0"),
        ("E", "7 ", "1", "7 / 1.4 ", "1/ 0"),
        ("F", " MT", "", " MT/  MT", "0/ 0"),
        ("G", "0", "", ".25 MT/ .05 MT", "1/ 0"),
    }


def test_report_typed(ledger_of):
    rows = {r.product_name: r for r in S.sales_report(_units_ledger(ledger_of), "2024-03-05").collect()}
    b, f, g = rows["B"], rows["F"], rows["G"]
    assert (b.qty, b.day_unit, b.no_of_trucks, b.tot_qty, b.avg_qty, b.unit) == (Decimal("1.5"), "MT", 1, Decimal("1.5"), Decimal("0.3"), "MT")
    assert (f.qty, f.day_unit, f.no_of_trucks, f.tot_qty, f.tot_no_of_trucks) == (None, "MT", 0, None, 0)
    assert (g.qty, g.day_unit, g.no_of_trucks, g.tot_qty, g.avg_qty) == (0, None, 0, Decimal("0.25"), Decimal("0.05"))
    assert rows["E"].unit is None and rows["C"].unit == "LTR"


def test_fan_out_and_by_unit(ledger_of):
    day = "2024-03-05"
    led = ledger_of(
        [
            dict(vrdate=day, item_name="H", aum="KGS", aqtyissued=2000),
            dict(vrdate=day, item_name="h", aum="KGS", aqtyissued=1000),
            dict(vrdate=day, item_name="H", aum="LTR", aqtyissued=5),
        ]
    )
    assert S.sales_report(led, day).count() == 6
    by_unit = {(r.qty, r.unit, r.tot_qty) for r in S.sales_report_by_unit(led, day).collect()}
    assert by_unit == {(3.0, "MT", 3.0), (5.0, "LTR", 5.0)}


def test_half_up_rounding(ledger_of):
    rows = [dict(vrdate="2024-03-01", item_name="K", vrno=i, aqtyissued=1) for i in range(3)]
    rows += [dict(vrdate="2024-03-01", item_name="L", vrno=i, aqtyissued=1) for i in range(5)]
    rows += [dict(vrdate="2024-03-02", item_name="M", aqtyissued=250)]
    got = {r.product_name: r for r in S.sales_mtd(ledger_of(rows), "2024-03-02").collect()}
    assert got["K"].avg_no_of_trucks == 2 and got["L"].avg_no_of_trucks == 3
    assert got["M"].avg_qty == Decimal("0.13")


def test_average_rounds_once(ledger_of):
    # 14.999 kg over 3 days = 0.0049996... t/day: exactly 0.00, while rounding first to 6 decimals
    # (0.005000) and then to 2 would give 0.01.  Same for the text form and the multi-date form.
    rows = [dict(vrdate="2024-03-03", item_name="K", aqtyissued=Decimal("14.999"))]
    led = ledger_of(rows)
    assert S.sales_mtd(led, "2024-03-03").collect()[0].avg_qty == 0.0
    assert S.sales_report_text(led, "2024-03-03").collect()[0].tot_avg_qty == ".01 MT/ 0 MT"
    from ledgerday.functions.dates import date_spine
    from ledgerday.operators.sales_multi import sales_report_multi

    multi = sales_report_multi(led, date_spine(led.sparkSession, "2024-03-03", "2024-03-03")).collect()
    assert [r.avg_qty for r in multi] == [0.0]


def test_first_of_month_leap_day_and_new_year(ledger_of):
    led = ledger_of(
        [
            dict(vrdate="2000-02-29", item_name="N", aqtyissued=580),
            dict(vrdate="2000-01-31", item_name="N", aqtyissued=999),
            dict(vrdate="2001-01-01", item_name="P", aqtyissued=100, aum="LTR"),
            dict(vrdate="2000-12-31", item_name="P", aqtyissued=999, aum="LTR"),
        ]
    )
    leap = S.sales_report_text(led, "2000-02-29").collect()
    assert [tuple(r) for r in leap] == [("N", ".58 MT", "1", ".58 MT/ .02 MT", "1/ 0")]
    jan = S.sales_report_text(led, "2001-01-01").collect()
    assert [tuple(r) for r in jan] == [("P", "100 LTR", "1", "100 LTR/ 100 LTR", "1/ 1")]
    cal = report_calendar(led.select(F.col("vrdate").alias("report_date")).distinct())
    got = {r.report_date: (r.date_text, r.month_start, r.day_of_month) for r in cal.collect()}
    assert got[D("2000-02-29")] == ("29/02/2000", D("2000-02-01"), "29")
    assert got[D("2001-01-01")] == ("01/01/2001", D("2001-01-01"), "01")


def test_month_start_override(ledger_of):
    # The month start may be set explicitly: the range then spans two months.
    led = ledger_of(
        [dict(vrdate="2024-02-28", item_name="Q", aqtyissued=1000), dict(vrdate="2024-03-02", item_name="Q", aqtyissued=1000)]
    )
    r = S.sales_mtd(led, "2024-03-02", month_start="2024-02-01").collect()[0]
    assert (r.tot_qty, r.avg_qty) == (2.0, 1.0)


def test_lower_case_ethanol_is_sold_as_ethanol(ledger_of):
    led = ledger_of([dict(vrdate="2024-03-05", item_name=ETHANOL_ITEM.lower(), aqtyissued=1000)])
    assert [r.product_name for r in S.sales_report(led, "2024-03-05").collect()] == ["ETHANOL"]


def test_zero_sums_in_tonnes_and_litres(ledger_of):
    day = "2024-03-05"
    led = ledger_of(
        [
            dict(vrdate=day, item_name="Z", aum="KGS", aqtyissued=0),
            dict(vrdate=day, item_name="Y", aum="LTR", aqtyissued=0),
            dict(vrdate=day, item_name="Y", aum="LTR", aqtyissued=-2.5),
            dict(vrdate=day, item_name="Y", aum="LTR", aqtyissued=2.5),
        ]
    )
    got = {r.product_name: tuple(r)[1:] for r in S.sales_report_text(led, day).collect()}
    assert got == {
        "Z": ("0 MT", "1", "0 MT/ 0 MT", "1/ 0"),
        "Y": ("0 LTR", "3", "0 LTR/ 0 LTR", "3/ 1"),
    }


def test_sums_stay_exact_decimals(ledger_of):
    big = Decimal("99999999999999.901")
    led = ledger_of([dict(vrdate="2024-03-05", item_name="Z", aum="LTR", aqtyissued=big, vrno=i) for i in range(3)])
    assert S.sales_report(led, "2024-03-05").first().tot_qty == 3 * big
    assert S.sales_day(led, "2024-03-05").first().qty == 3 * big
    report = S.sales_report(led, "2024-03-05")
    assert not [f for f in report.schema if f.dataType.typeName() == "double"]
    assert report.schema["tot_qty"].dataType.typeName() == report.schema["avg_qty"].dataType.typeName() == "decimal"
