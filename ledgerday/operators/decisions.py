"""J2 — what to do for each (date, channel): ``send``, ``already_sent`` or ``not_ready``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerday.constants import CHANNELS
from ledgerday.operators.calendar import with_channels


def send_decisions(readiness: DataFrame, log: DataFrame, channels: tuple[str, ...] = CHANNELS) -> DataFrame:
    """An unready date is ``not_ready`` whatever the log says; else the log decides."""
    per_channel = with_channels(readiness.select("report_date", "ready"), channels)
    sent = log.select("channel", F.col("sent_date").alias("report_date")).distinct().withColumn("_sent", F.lit(True))
    joined = per_channel.join(sent, ["channel", "report_date"], "left")
    decision = (
        F.when(~F.col("ready"), F.lit("not_ready"))
        .when(F.col("_sent").isNotNull(), F.lit("already_sent"))
        .otherwise(F.lit("send"))
    )
    return joined.select("report_date", "channel", decision.alias("decision"))
