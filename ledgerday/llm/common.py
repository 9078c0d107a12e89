"""Helpers shared by the operators: table access, shared scratch tables, words, memos."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerday.session import scratch_path

# Keeps 0-9, a-z and every byte from 0x80 on, lowers A-Z, turns the rest into blanks.
_WORD_BYTES = bytes(
    c if c >= 0x80 or chr(c).isdigit() or "a" <= chr(c) <= "z" else c + 32 if "A" <= chr(c) <= "Z" else 32
    for c in range(256)
)

#: Whole texts that are sent to a Python worker at a time (see :func:`bounded_batches`).
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Hold the session's Arrow batches to ``rows`` rows (fewer stay): a batch of whole texts is in the
    memory of an executor and of its Python worker several times over."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts lineage without a second computation (a checkpoint runs its plan
    twice), compresses, and lets later readers prune columns.  Any executor may
    be lost afterwards.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def drop_tables(*tables: DataFrame) -> None:
    """Delete tables of :func:`shared_table` whose successors are written, and let go of the
    shuffles that made them.  Nothing that is still to run may read them."""
    spark = tables[0].sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for df in tables:
        path = jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(conf).delete(path, True)
    jvm.System.gc()  # Spark removes the shuffles of plans that are gone


def streamed_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[list, list[list]]]:
    """The groups of rows that are sorted by their first ``n_keys`` columns: the key, and the other columns' values."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:n_keys] != key:
                if rows:
                    yield key, list(zip(*rows))
                key, rows = row[:n_keys], []
            rows.append(row[n_keys:])
    if rows:
        yield key, list(zip(*rows))


def words(text: str | None) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` as UTF-8; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


def blank_separated(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; null has none."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


class Memo(dict):
    """Values of frequent words, computed on first use; emptied when it holds ``size`` words.

    Only a cache: long words (over ``longest`` bytes) are computed each time, so
    a worker's memory stays bounded whatever the corpus holds.
    """

    def __init__(self, compute: Callable[[bytes], object], size: int = 400_000, longest: int = 64):
        super().__init__()
        self._compute, self._size, self._longest = compute, size, longest

    def __missing__(self, word: bytes):
        value = self._compute(word)
        if len(word) <= self._longest:
            if len(self) >= self._size:
                self.clear()
            self[word] = value
        return value
