"""The corpus pipeline over ``documents``: low-quality documents go, fuzzy repeated
lines go, one document of each near-duplicate class stays, documents that hold
benchmark items go, and the rest is packed into training sequences.

Every stage but the last returns the columns of ``documents``; each works on
all that its predecessor kept, and more columns pass through.  ``n_chars``
follows a changed text.  An empty table gives an empty table.

=========================  ====================================  =====================================
Stage                      Null, empty or blank text             Rows repeated in full
=========================  ====================================  =====================================
quality_classifier         as the model scores no words          treated alike
line_dedup                 stays; a text that loses every line   each keeps the lines, once in itself
                           goes, as they stand in another text
ngram_join                 stays                                 one stays
benchmark_decontamination  stays                                 treated alike
packing                    a separator                           each is packed
=========================  ====================================  =====================================

The session's Arrow batches are held to a thousand rows from the first stage on.

Null ids are ids like others: they come first among lines, last among documents of a class.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerday.llm.classifier import fit_quality, quality_score
from ledgerday.llm.common import bounded_batches, drop_tables, shared_table, table
from ledgerday.llm.decontamination import decontaminate
from ledgerday.llm.line_dedup import dedup_lines
from ledgerday.llm.ngram_join import one_of_each
from ledgerday.llm.packing import TURN_LIMITS, pack_documents
from ledgerday.llm.queries import THRESHOLD, vocabulary_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.where(quality_score(docs, model, F.col("text")) >= THRESHOLD)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = dedup_lines(docs, emptied=False)
    return cut.withColumn("n_chars", F.length("text").cast("long"))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, repeats=False)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, vocabulary_path(), TURN_LIMITS, turns=True).drop("ids")


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]:
    @wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return work(spark, docs, sf_dir)

    return work.__name__, stage


STAGES = [_stage(f) for f in (quality_classifier, line_dedup, ngram_join, benchmark_decontamination, packing)]

#: No SQL: a trained model, union-find, alignment and a tokenizer; tests/llm has brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), name)
        if before is not None:
            drop_tables(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
