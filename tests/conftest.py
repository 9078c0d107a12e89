from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from ledgerday.schemas import CONTACTS_SCHEMA, LEDGER_SCHEMA, SEND_LOG_SCHEMA  # noqa: E402
from ledgerday.session import scratch_dir  # noqa: E402
from ledger_helpers import D, q  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[*]")
        .appName("ledgerday-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    scratch_dir(s)
    yield s


_LEDGER_DEFAULTS = dict(
    vrno=1, vrdate=None, tcode="S", item_name="X", item_nature="FG", um="KGS", aum="KGS",
    qtyissued=None, qtyrecd=None, aqtyissued=None, acc_name="PARTY",
)


@pytest.fixture
def ledger_of(spark):
    """Build a ledger from dicts; missing fields take harmless defaults."""

    def make(rows):
        out = []
        for r in rows:
            full = {**_LEDGER_DEFAULTS, **r}
            full["vrdate"] = D(full["vrdate"]) if isinstance(full["vrdate"], str) else full["vrdate"]
            for k in ("qtyissued", "qtyrecd", "aqtyissued"):
                full[k] = q(full[k])
            out.append(tuple(full[f.name] for f in LEDGER_SCHEMA.fields))
        return spark.createDataFrame(out, LEDGER_SCHEMA)

    return make


@pytest.fixture
def log_of(spark):
    def make(rows):
        return spark.createDataFrame([(c, D(d), s) for c, d, s in rows], SEND_LOG_SCHEMA)

    return make


@pytest.fixture
def contacts_of(spark):
    def make(rows):
        return spark.createDataFrame(rows, CONTACTS_SCHEMA)

    return make
