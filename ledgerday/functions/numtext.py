"""Text rendering of report numbers.

A decimal is shown without trailing zeros and without the leading zero of a
pure fraction (``12.5``, ``12``, ``.5``, ``-.25``), and a NULL number joins a
unit as an empty string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerday.functions import items as it
from ledgerday.params import Items

# The three rewrites applied to a decimal's plain string.
TRAILING_ZEROS = r"(\.[0-9]*?)0+$"
BARE_POINT = r"\.$"
LEADING_ZERO = r"^(-?)0\."


def number_text(value: Column) -> Column:
    s = value.cast("string")
    s = F.regexp_replace(s, TRAILING_ZEROS, "$1")
    s = F.regexp_replace(s, BARE_POINT, "")
    return F.regexp_replace(s, LEADING_ZERO, "$1.")


def quantity_text(number: Column, unit: Column) -> Column:
    """``number || ' ' || unit`` where NULL on either side counts as empty."""
    return F.concat(F.coalesce(number_text(number), F.lit("")), F.lit(" "), F.coalesce(unit, F.lit("")))


def total_text(total: Column, unit: Column, items: Items) -> Column:
    return F.when(
        it.is_kg(unit, items, case_sensitive=False), quantity_text(it.tonnes(total, items), F.lit(items.tonne_unit))
    ).otherwise(quantity_text(total, unit))


def average_text(total: Column, unit: Column, day: Column, items: Items) -> Column:
    return F.when(
        it.is_kg(unit, items, case_sensitive=False),
        quantity_text(it.average_tonnes(total, day, items), F.lit(items.tonne_unit)),
    ).otherwise(quantity_text(it.average_plain(total, day), unit))
