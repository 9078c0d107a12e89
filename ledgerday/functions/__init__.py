"""Column-level helpers built from ``pyspark.sql.functions``."""

from ledgerday.functions.dates import (
    as_date, date_spine, date_text, in_months_of, ledger_span, month_start, within,
)
from ledgerday.functions.items import average_value, product_name, row_tonnes, total_value, unit_label
from ledgerday.functions.numtext import average_text, number_text, quantity_text, total_text

__all__ = [
    "as_date", "date_spine", "date_text", "in_months_of", "ledger_span", "month_start", "within",
    "average_value", "product_name", "row_tonnes", "total_value", "unit_label",
    "average_text", "number_text", "quantity_text", "total_text",
]
