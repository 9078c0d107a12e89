"""Values that the tests of the reporting engine share."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def q(x) -> Decimal | None:
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.001"))
