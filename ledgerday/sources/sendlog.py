"""A3 / A4 — the send log stored as JSON, one document per channel.

Each channel's document is ``{"sentDates": ["YYYY-MM-DD", ...]}`` in insertion
order.  Two layouts are read: a mapping ``{channel: file}`` (one file per
channel) and a folder partitioned by ``channel=<name>`` as written by
:func:`write_send_log`.  A missing, corrupt or field-less document counts as
"nothing sent".
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerday.schemas import SEND_LOG_FILE_SCHEMA, SEND_LOG_SCHEMA


def path_exists(spark: SparkSession, path: str) -> bool:
    """Metadata check through the Hadoop file system of ``path`` (no data read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _explode(doc: DataFrame, channel) -> DataFrame:
    entries = doc.select(channel.alias("channel"), F.posexplode("sentDates").alias("seq", "value"))
    return entries.select(
        "channel",
        # An entry that is not an ISO date can never match a report date.
        F.try_to_timestamp(F.col("value"), F.lit("yyyy-MM-dd")).cast("date").alias("sent_date"),
        F.col("seq").cast("long").alias("seq"),
    ).where(F.col("sent_date").isNotNull())


def empty_send_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SEND_LOG_SCHEMA)


def read_send_log(spark: SparkSession, location: str | Mapping[str, str]) -> DataFrame:
    """Return ``send_log(channel, sent_date, seq)``; ``seq`` is the position in the array."""
    reader = spark.read.option("multiLine", "true").option("mode", "PERMISSIVE")
    if isinstance(location, Mapping):
        parts = [
            _explode(reader.schema(SEND_LOG_FILE_SCHEMA).json(path), F.lit(channel))
            for channel, path in location.items()
            if path_exists(spark, path)
        ]
        out = empty_send_log(spark)
        for p in parts:
            out = out.unionByName(p)
        return out
    if not path_exists(spark, location):
        return empty_send_log(spark)
    schema = T.StructType(SEND_LOG_FILE_SCHEMA.fields + [T.StructField("channel", T.StringType(), True)])
    return _explode(reader.schema(schema).json(location), F.col("channel"))


def send_log_documents(log: DataFrame) -> DataFrame:
    """One row per channel holding its ordered ``sentDates`` array.

    The array is the document itself, so its length is the log's retention
    (apply :func:`ledgerday.operators.sendlog.send_log_retained` first).
    """
    entries = F.collect_list(F.struct("seq", F.date_format("sent_date", "yyyy-MM-dd").alias("d")))
    return log.groupBy("channel").agg(
        F.transform(F.array_sort(entries), lambda e: e["d"]).alias("sentDates")
    )


def write_send_log(log: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the log as one JSON document per channel under ``channel=<name>/``.

    Write to a new path: a job must not overwrite the folder it is reading.
    """
    send_log_documents(log).write.mode(mode).partitionBy("channel").json(path)


# --- versioned store: each run writes a new version, readers take the newest complete one.

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def log_versions(spark: SparkSession, base: str, complete_only: bool = True) -> list[int]:
    """Versions (``v=<n>`` folders; with ``_SUCCESS`` when ``complete_only``) under ``base``, oldest first."""
    fs, root = _fs(spark, base)
    if not fs.exists(root):
        return []
    out = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("v=") and name[2:].isdigit():
            if not complete_only or fs.exists(status.getPath().suffix("/_SUCCESS")):
                out.append(int(name[2:]))
    return sorted(out)


def read_latest_send_log(spark: SparkSession, base: str) -> DataFrame:
    """The newest complete version; a version left half-written by a failed run is ignored."""
    versions = log_versions(spark, base)
    return read_send_log(spark, f"{base.rstrip('/')}/v={versions[-1]}") if versions else empty_send_log(spark)


def next_log_version(spark: SparkSession, base: str) -> int:
    """The number that follows every version, also those that a failed run left incomplete."""
    versions = log_versions(spark, base, complete_only=False)
    return versions[-1] + 1 if versions else 0


def write_next_send_log(spark: SparkSession, log: DataFrame, base: str, version: int | None = None) -> str:
    """Write ``log`` as the next version (never overwrites the version it was read from)."""
    n = next_log_version(spark, base) if version is None else version
    path = f"{base.rstrip('/')}/v={n}"
    write_send_log(log, path)
    return path


# File names of the one-file-per-channel log layout.
REFERENCE_LOG_FILES = {"email": "email_log.json", "whatsapp": "whatsapp_log.json"}


def read_log_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Read a folder holding ``email_log.json`` and ``whatsapp_log.json`` (either may be missing)."""
    return read_send_log(spark, {c: f"{folder.rstrip('/')}/{f}" for c, f in REFERENCE_LOG_FILES.items()})


def import_log_folder(spark: SparkSession, folder: str, base: str) -> str:
    """Start a versioned log store from such a folder; returns the version written."""
    return write_next_send_log(spark, read_log_folder(spark, folder), base)
