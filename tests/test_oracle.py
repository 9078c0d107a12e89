"""Every registered query equals its independent DuckDB SQL on the fixture views."""

from __future__ import annotations

import pytest
from compare import compare, duck
from ledger_helpers import SF_CHECK, SF_SMALL

import __spark_entry__ as entry_mod

from ledgerday.oracle import ORACLE_SQL as ORACLE
from ledgerday.registry import QUERIES

# Check figures of the fixture (FIXTURES.md §3), by scale.
EXPECTED_ROWS = {
    SF_SMALL: {
        "sales_rows": 1472, "sales_report": 5, "sales_report_by_unit": 5, "report_recipients": 3,
        "recipient_contacts": 107, "report_readiness": 2499,
    },
    SF_CHECK: {
        "sales_rows": 15580,
        "sales_report": 31,
        "sales_report_by_unit": 20,
        "coal_availability": 2142,
        "maize_availability": 2102,
        "ethanol_receipts": 1939,
        "report_readiness": 2499,
        "pending_dates": 8,
        "ledger_normalised": 60000,
        "recipient_contacts": 1060,
        "report_recipients": 3,
    },
}


def test_every_key_has_an_oracle():
    assert len(QUERIES) == 26
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE) <= set(entry_mod.oracle_sql())


@pytest.fixture(scope="module", params=[SF_SMALL, SF_CHECK])
def scale(request):
    return request.param, duck(request.param)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, scale, name):
    sf, con = scale
    problems, n, _, _ = compare(spark, con, name, QUERIES[name], ORACLE[name], sf)
    assert not problems, problems
    expected = EXPECTED_ROWS[sf].get(name)
    if expected is not None:
        assert n == expected


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() == 10
    assert df.columns == [
        "product_name", "qty", "day_unit", "no_of_trucks", "tot_qty", "avg_qty", "unit",
        "tot_no_of_trucks", "avg_no_of_trucks",
    ]
