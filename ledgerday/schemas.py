"""Explicit schemas of the three inputs and the casts that conform a source to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QTY = T.DecimalType(18, 3)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("vrno", T.LongType(), True),
        T.StructField("vrdate", T.DateType(), False),
        T.StructField("tcode", T.StringType(), False),
        T.StructField("item_name", T.StringType(), True),
        T.StructField("item_nature", T.StringType(), True),
        T.StructField("um", T.StringType(), True),
        T.StructField("aum", T.StringType(), True),
        T.StructField("qtyissued", QTY, True),
        T.StructField("qtyrecd", QTY, True),
        T.StructField("aqtyissued", QTY, True),
        T.StructField("acc_name", T.StringType(), True),
    ]
)

CONTACTS_SCHEMA = T.StructType(
    [
        T.StructField("report_name", T.StringType(), False),
        T.StructField("email", T.StringType(), True),
        T.StructField("coal_avail_email", T.BooleanType(), False),
        T.StructField("maize_avail_email", T.BooleanType(), False),
        T.StructField("mis_email_monthly", T.BooleanType(), False),
        T.StructField("is_cc", T.BooleanType(), False),
        T.StructField("is_bcc", T.BooleanType(), False),
    ]
)

SEND_LOG_SCHEMA = T.StructType(
    [
        T.StructField("channel", T.StringType(), False),
        T.StructField("sent_date", T.DateType(), False),
        T.StructField("seq", T.LongType(), False),
    ]
)

# On disk one JSON document per channel: {"sentDates": ["YYYY-MM-DD", ...]}
SEND_LOG_FILE_SCHEMA = T.StructType(
    [T.StructField("sentDates", T.ArrayType(T.StringType()), True)]
)

# Partition column added when the ledger is stored by month (see sources.ledger).
MONTH_PARTITION = "vrmonth"


def conform(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Select the schema's columns, cast to its types (JDBC NUMBER/DATE arrive wider)."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"source lacks columns {missing}")
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    cols += [F.col(c) for c in keep if c in df.columns]
    return df.select(*cols)


def conform_ledger(df: DataFrame) -> DataFrame:
    return conform(df, LEDGER_SCHEMA, keep=(MONTH_PARTITION,))


def conform_contacts(df: DataFrame) -> DataFrame:
    return conform(df, CONTACTS_SCHEMA)


def conform_send_log(df: DataFrame) -> DataFrame:
    return conform(df, SEND_LOG_SCHEMA)
