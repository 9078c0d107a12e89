"""J6 — the daily job: every date due, in one set of DataFrames (no per-date loop).

Steps: dates due (pending look-back of any channel, plus the target date) →
readiness of those dates (one scan) → alerts and per-channel decisions →
sales report of every date to send (one scan, shared by both sides) →
outbox rows → new send log.

The ledger scan is bounded by literal dates computed on the driver from
``today`` and the look-back, so only the weeks concerned are read (and only
their month partitions when the ledger is stored by month).  Readiness is
checkpointed to the shared checkpoint folder: the outbox and the new log must
come from the *same* decisions, even if the ledger changes between the two
writes, and a lost executor then recomputes from the checkpoint instead of
from the ledger.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerday.functions.dates import DateLike, as_date
from ledgerday.operators.availability import availability_alerts, report_readiness
from ledgerday.operators.calendar import dates_to_process
from ledgerday.operators.contacts import recipient_contacts, report_recipients
from ledgerday.operators.decisions import send_decisions
from ledgerday.operators.outbox import message_outbox
from ledgerday.operators.sales import typed_columns
from ledgerday.operators.sales_multi import multi_frame, report_lines
from ledgerday.operators.sendlog import send_log_append
from ledgerday.params import DEFAULT_ITEMS, Items, RunOptions
from ledgerday.schemas import MONTH_PARTITION
from ledgerday.session import materialize
from ledgerday.sources.sendlog import next_log_version, path_exists, write_next_send_log


class DailyRun:
    """The outputs of one run; each is built on first access and then kept.

    ``readiness`` — the only output read from the ledger — is checkpointed
    (eagerly, to the shared checkpoint folder), so alerts, decisions, outbox
    and new log all derive from the same values; the send log is only read
    (the new one goes to a new path), so nothing else can change under them.
    """

    def __init__(
        self,
        spark: SparkSession,
        ledger: DataFrame,
        contacts: DataFrame,
        log: DataFrame,
        today: DateLike,
        items: Items = DEFAULT_ITEMS,
        opts: RunOptions = RunOptions(),
        checkpoint: bool = True,
        only_dates: list[DateLike] | None = None,
    ) -> None:
        self.spark, self.ledger, self.contacts, self.log = spark, ledger, contacts, log
        self.today, self.items, self.opts, self.checkpoint = as_date(today), items, opts, checkpoint
        self.only_dates = sorted({as_date(d) for d in only_dates}) if only_dates else None
        # The scan's literal bounds: the look-back, or just the months of the given dates.
        self.window = None if self.only_dates else run_window(today, opts)
        self.months = sorted({d.replace(day=1) for d in self.only_dates}) if self.only_dates else None
        if self.only_dates and MONTH_PARTITION not in ledger.columns:
            self.window = (self.only_dates[0], self.only_dates[-1])

    def _keep(self, df: DataFrame) -> DataFrame:
        if not self.checkpoint:
            return df
        return materialize(df)

    @cached_property
    def dates(self) -> DataFrame:
        """The dates due: pending look-back plus target, or exactly ``only_dates`` when given."""
        if self.only_dates:
            rows = [(d,) for d in self.only_dates]
            return self.spark.createDataFrame(rows, "report_date date")
        o = self.opts
        return dates_to_process(self.spark, self.log, self.today, o.max_days_back, o.channels, o.date_offset)

    @cached_property
    def readiness(self) -> DataFrame:
        return self._keep(report_readiness(self.ledger, self.dates, self.items, self.window, self.months))

    @cached_property
    def alerts(self) -> DataFrame:
        return availability_alerts(self.readiness, self.opts.alert_materials)

    @cached_property
    def decisions(self) -> DataFrame:
        return send_decisions(self.readiness, self.log, self.opts.channels)

    @cached_property
    def recipients(self) -> DataFrame:
        """Sizes of every report's lists."""
        return report_recipients(self.contacts, self.opts.reports)

    @cached_property
    def addresses(self) -> DataFrame:
        """``kind, report_name, role, email``: the recipients of the outbox's messages, by ``kind``."""
        return recipient_contacts(self.contacts, self.opts.reports)

    @cached_property
    def outbox(self) -> DataFrame:
        o = self.opts
        return message_outbox(self.alerts, self.decisions, self.recipients, o.reports, o.report_channel)

    @cached_property
    def report_frame(self) -> DataFrame:
        """Sums of every date whose report channel decided ``send``, checkpointed: rows and text are made from them."""
        o = self.opts
        dates = self.decisions.where((F.col("channel") == o.report_channel) & (F.col("decision") == "send"))
        bounds = (self.window[0].replace(day=1), self.window[1]) if self.window else None
        frame = multi_frame(self.ledger, dates.select("report_date"), self.items, between=bounds, months=self.months)
        return self._keep(frame)

    @cached_property
    def reports(self) -> DataFrame:
        """Sales report rows of every date whose report channel decided ``send``."""
        return self.report_frame.select("report_date", *typed_columns(F.dayofmonth("report_date"), self.items))

    @cached_property
    def report_text(self) -> DataFrame:
        """The same reports as text lines, by ``report_date`` and ``kind`` of their outbox message."""
        lines = report_lines(self.report_frame, self.items)
        kinds = F.array(*[F.lit(r.kind) for r in self.opts.reports if not r.material]).cast("array<string>")
        return lines.select("report_date", F.explode(kinds).alias("kind"), *lines.columns[1:])

    @cached_property
    def log_rows(self) -> DataFrame:
        """The new send log: every channel's ``send`` dates appended, then retention."""
        sent = self.decisions.where(F.col("decision") == "send").select(
            "channel", F.col("report_date").alias("sent_date")
        )
        return send_log_append(self.log, sent, self.opts.retain)


def run_window(today: DateLike, opts: RunOptions) -> tuple[dt.date, dt.date]:
    """First and last date a run can touch."""
    t = as_date(today)
    lo = t - dt.timedelta(days=max(opts.max_days_back, opts.date_offset))
    hi = t - dt.timedelta(days=min(1, opts.date_offset))
    return lo, hi


def daily_run(
    spark: SparkSession,
    ledger: DataFrame,
    contacts: DataFrame,
    log: DataFrame,
    today: DateLike,
    items: Items = DEFAULT_ITEMS,
    opts: RunOptions = RunOptions(),
    checkpoint: bool = True,
    only_dates: list[DateLike] | None = None,
) -> DailyRun:
    """The daily job for ``today``; ``only_dates`` processes exactly those dates instead."""
    return DailyRun(spark, ledger, contacts, log, today, items, opts, checkpoint, only_dates)


def write_daily_run(run: DailyRun, out_dir: str, log_base: str) -> str:
    """Write the run's outputs under ``run=<n>``, then - only once all succeeded - version n of the log.

    ``n`` is the number of the log version that the run commits, and that
    version is the commit: a folder names it in ``log`` and is committed once
    the version is complete.  A run that failed before has left no version n, so
    the repeated run takes the same number and replaces the folder; a committed
    run's folder is never touched again.  Outputs: ``reports``, ``report_text``, ``outbox``,
    ``addresses`` (joined to the outbox by ``kind``).  Returns the new log
    version's path; the version that the run read stays in force until then.
    """
    n = next_log_version(run.spark, log_base)
    folder = f"{out_dir.rstrip('/')}/run={n}"
    if is_committed(run.spark, folder):
        raise ValueError(f"{folder} belongs to a committed run; give this log another output folder")
    log = run.spark.range(1).select(F.lit(f"{log_base.rstrip('/')}/v={n}").alias("log"))
    log.write.mode("overwrite").json(f"{folder}/log")
    for name, rows in (("reports", run.reports), ("report_text", run.report_text), ("outbox", run.outbox)):
        rows = rows.hint("rebalance", F.col("report_date"))  # a few files a date
        rows.write.mode("overwrite").partitionBy("report_date").parquet(f"{folder}/{name}")
    run.addresses.write.mode("overwrite").partitionBy("kind").parquet(f"{folder}/addresses")
    return write_next_send_log(run.spark, run.log_rows, log_base, n)


def run_folder(out_dir: str, log_path: str) -> str:
    """The folder of the run that committed a log version."""
    return f"{out_dir.rstrip('/')}/run={log_path.rpartition('v=')[2]}"


def is_committed(spark: SparkSession, folder: str) -> bool:
    """Whether the log version that a run's folder names is complete."""
    if not path_exists(spark, f"{folder}/log/_SUCCESS"):
        return False
    log = spark.read.schema("log string").json(f"{folder}/log").first()["log"]
    return path_exists(spark, f"{log}/_SUCCESS")


def read_run(spark: SparkSession, out_dir: str, log_path: str, output: str) -> DataFrame:
    """An output of the run that committed a log version: what a sender reads.

    ValueError for a version that isn't complete, or whose run wrote elsewhere.
    """
    folder = run_folder(out_dir, log_path)
    if not is_committed(spark, folder):
        raise ValueError(f"{folder} isn't the folder of a committed run")
    return spark.read.parquet(f"{folder}/{output}")
