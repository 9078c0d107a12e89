"""Contiguous shards of nearly equal bytes from global prefix sums (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerday.llm.common import shared_table

#: Bytes a stored row takes besides its text.
ROW_BYTES = 16


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus the row's own bytes."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def byte_shards(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None
) -> DataFrame:
    """One row per input row: ``id, size, text_crc32, shard, slot``.

    Rows are put in the order of (id, text hash); the row that begins at byte b
    of that order's total T goes to shard ``floor(b * shards / T)``, so every
    shard is one contiguous run and no shard differs from T / shards by more
    than one document.  ``slot`` numbers a shard's rows from 0 without gaps.

    The order is dealt out by range to ``partitions`` partitions and stored
    once without texts; each partition's totals are summed, turned into offsets
    over the partitions (their number is the cluster's, not the data's), and
    added to the running sums inside each partition.  A null or repeated id is
    ordered by text hash and input position, so even one id on a third of the
    rows spreads over many ranges.

    Null id or text: a row like any other (size ``ROW_BYTES``, crc of no
    bytes).  Empty table: no rows.  Fewer rows than shards: some shards are
    empty.  Other columns are ignored.
    """
    spark = docs.sparkSession
    parts = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards)
    rows = docs.select(
        F.col(id_col).alias("id"),
        text_size(F.col(text_col)).alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit(""))).alias("text_crc32"),
        F.xxhash64(F.col(text_col)).alias("h"),
        F.monotonically_increasing_id().alias("at"),
    )
    order = ("id", "h", "at")
    dealt = shared_table(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "shards")

    totals = dealt.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("part").orderBy(*order)
    placed = (
        dealt.withColumn("byte", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("row", F.row_number().over(inside) - 1)
        .join(offsets, "part")
        .select(
            "id", "size", "text_crc32", (F.col("row") + F.col("rows_before")).alias("row"),
            F.floor(
                (F.coalesce("byte", F.lit(0)) + F.col("bytes_before")).cast("decimal(20,0)") * shards / F.col("total")
            ).cast("int").alias("shard"),
        )
    )
    placed = shared_table(placed, "placed")
    starts = placed.groupBy("shard").agg(F.min("row").alias("first_row"))
    return placed.join(starts, "shard").select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("row") - F.col("first_row")).alias("slot")
    )
