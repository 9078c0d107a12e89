"""A1 + C1 + C3 — the ledger with its product alias and tonne quantities."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerday.functions import items as it
from ledgerday.params import DEFAULT_ITEMS, Items


def ledger_normalised(ledger: DataFrame, items: Items = DEFAULT_ITEMS) -> DataFrame:
    return ledger.select(
        *ledger.columns,
        it.product_name("item_name", items).alias("item"),
        it.row_tonnes("qtyissued", "um", items).alias("qtyissued_mt"),
        it.row_tonnes("qtyrecd", "um", items).alias("qtyrecd_mt"),
    )
