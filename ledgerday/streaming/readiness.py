"""The readiness gate (E4) run incrementally with Structured Streaming.

The per-date counts are kept up to date as new ledger files arrive, in any
order of their dates: the state is one small row per movement date, so no
watermark drops a late line.  Each micro-batch appends the dates it changed,
with their cumulative counts, to a Parquet folder through ``foreachBatch``; the
stream's checkpoint lets it restart after a failure without double counting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerday.operators.availability import MATERIALS, _material_condition
from ledgerday.params import DEFAULT_ITEMS, Items
from ledgerday.schemas import LEDGER_SCHEMA


def readiness_updates(
    spark: SparkSession,
    source: str,
    items: Items = DEFAULT_ITEMS,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming ``report_date, coal_rows, maize_rows, ethanol_rows, ready`` (cumulative per date)."""
    reader = spark.readStream.schema(LEDGER_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = (
        reader.load(source)
        .where(F.col("tcode") == F.lit(items.production_code))
        .where(F.col("item_name").isin(items.coal, items.maize, items.ethanol))
        .where(F.col("vrdate").isNotNull())
    )
    counts = rows.groupBy(F.col("vrdate").alias("report_date")).agg(
        *[F.count_if(_material_condition(m, items)).alias(f"{m}_rows") for m in MATERIALS]
    )
    ready = F.lit(True)
    for m in MATERIALS:
        ready = ready & (F.col(f"{m}_rows") > 0)
    return counts.select(
        "report_date",
        *[F.col(f"{m}_rows").cast("bigint").alias(f"{m}_rows") for m in MATERIALS],
        ready.alias("ready"),
    )


def start_readiness_stream(
    spark: SparkSession,
    source: str,
    out_dir: str,
    checkpoint_dir: str,
    items: Items = DEFAULT_ITEMS,
    fmt: str = "parquet",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops (a scheduled run)."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("append").parquet(out_dir)

    updates = readiness_updates(spark, source, items, fmt, max_files_per_trigger)
    writer = (
        updates.writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint_dir)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()


def latest_readiness(spark: SparkSession, out_dir: str) -> DataFrame:
    """The newest counts of every date the stream has reported (last batch wins)."""
    updates = spark.read.parquet(out_dir)
    cols = [c for c in updates.columns if c not in ("report_date", "batch_id")]
    latest = updates.groupBy("report_date").agg(
        F.max_by(F.struct(*cols), F.col("batch_id")).alias("r")
    )
    return latest.select("report_date", *[F.col(f"r.{c}").alias(c) for c in cols])
