"""A4, F3 — appending to the send log and keeping the last N entries per channel.

The log has one entry per channel and date.  Retention is a per-channel top-N
by insertion order; written as ``row_number() <= N`` it is planned with a
partial ``WindowGroupLimit`` before the shuffle, so each task forwards at most
N rows per channel whatever the log's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerday.constants import LOG_RETENTION


def send_log_retained(log: DataFrame, retain: int = LOG_RETENTION) -> DataFrame:
    """the last ``retain`` entries of each channel by ``seq`` (insertion order, not date)."""
    w = Window.partitionBy("channel").orderBy(F.col("seq").desc())
    return log.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= retain).drop("_rn")


def send_log_append(log: DataFrame, new_dates: DataFrame, retain: int = LOG_RETENTION) -> DataFrame:
    """A4: add (channel, sent_date) pairs not yet logged, oldest first, then keep the last ``retain``.

    In a channel that received something, ``seq`` becomes the position in its
    document: 0, 1, ... in insertion order, new entries last and in date order.
    As with the file it replaces, a channel that received nothing new is
    returned unchanged.  One aggregate by (channel, date) and one sort by
    channel, each over at most one row per channel and day of the calendar.
    """
    merged = (
        log.select("channel", "sent_date", F.col("seq").cast("long").alias("seq"))
        .unionByName(
            new_dates.select(
                "channel", F.col("sent_date").cast("date").alias("sent_date"), F.lit(None).cast("long").alias("seq")
            )
        )
        .groupBy("channel", "sent_date")
        .agg(F.sort_array(F.collect_list("seq")).alias("seqs"))
        .select("channel", "sent_date", F.explode_outer("seqs").alias("seq"))
    )
    newest_first = Window.partitionBy("channel").orderBy(
        F.col("seq").desc_nulls_first(), F.col("sent_date").desc()
    )
    channel = Window.partitionBy("channel").orderBy(F.col("seq").desc_nulls_first(), F.col("sent_date").desc()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    ranked = merged.select(
        "channel",
        "sent_date",
        "seq",
        F.row_number().over(newest_first).alias("_back"),
        F.count(F.lit(1)).over(channel).alias("_n"),
        F.max(F.col("seq").isNull()).over(channel).alias("_grew"),
    )
    position = (F.least(F.col("_n"), F.lit(retain)) - F.col("_back")).cast("long")
    return ranked.where(~F.col("_grew") | (F.col("_back") <= retain)).select(
        "channel", "sent_date", F.when(F.col("_grew"), position).otherwise(F.col("seq")).alias("seq")
    )
