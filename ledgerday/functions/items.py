"""Column expressions for item names and units (all built-in, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerday.params import Items


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def product_name(item: Column | str, items: Items, compare_upper: bool = True) -> Column:
    """The long ethanol name becomes the short label, every other name is upper-cased.

    The sales report compares the upper-cased name; the availability checks
    compare the raw name.  Outer blanks are kept in both.
    """
    item = _col(item)
    up = F.upper(item)
    key = up if compare_upper else item
    return F.when(key == F.lit(items.ethanol), F.lit(items.ethanol_label)).otherwise(up)


def is_kg(unit: Column | str, items: Items, case_sensitive: bool) -> Column:
    unit = _col(unit)
    return (unit if case_sensitive else F.upper(unit)) == F.lit(items.kg_unit)


def row_tonnes(qty: Column | str, unit: Column | str, items: Items) -> Column:
    """Row-level conversion: a ``KGS`` row (case-sensitive) is divided by 1000."""
    qty = _col(qty)
    return F.when(is_kg(unit, items, case_sensitive=True), qty / F.lit(items.kg_per_tonne)).otherwise(qty)


def tonnes(total: Column, items: Items) -> Column:
    """A kilogram total in tonnes, rounded to 2 (total / 1000 is exact at 6 decimals)."""
    return F.round((total / F.lit(items.kg_per_tonne)).cast("decimal(38,6)"), 2)


def _exact(total: Column) -> Column:
    # A ledger sum has 3 decimals.  At precision 28 a division by an int keeps
    # 13 decimals, finer than the smallest distance (1e-6 / 31) between such a
    # quotient and a rounding boundary, so the final rounding to 2 is exact:
    # no double rounding through an intermediate scale.
    return total.cast("decimal(28,3)")


def average_tonnes(total: Column, day: Column, items: Items) -> Column:
    """Daily average in tonnes from the unrounded kilogram total, rounded to 2."""
    return F.round(_exact(total) / (F.lit(items.kg_per_tonne) * day), 2)


def average_plain(total: Column, day: Column) -> Column:
    """Daily average in the row unit, rounded to 2."""
    return F.round(_exact(total) / day, 2)


def total_value(total: Column, unit: Column, items: Items) -> Column:
    """Total-level conversion: ``kgs`` in any case gives tonnes rounded to 2, else the raw sum."""
    return F.when(is_kg(unit, items, case_sensitive=False), tonnes(total, items)).otherwise(total)


def average_value(total: Column, unit: Column, day: Column, items: Items) -> Column:
    """Daily average from the unrounded total, rounded to 2 in both branches."""
    return F.when(is_kg(unit, items, case_sensitive=False), average_tonnes(total, day, items)).otherwise(
        average_plain(total, day)
    )


def unit_label(unit: Column, items: Items) -> Column:
    return F.when(is_kg(unit, items, case_sensitive=False), F.lit(items.tonne_unit)).otherwise(unit)
