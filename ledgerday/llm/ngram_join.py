"""N-gram Jaccard join of documents with Bayesian candidate pruning.

Signatures of candidate pairs are compared a few values at a time; a pair goes
as soon as the posterior probability that its similarity reaches the threshold
(uniform prior, binomial matches) is below the tolerance.  What is left is
checked exactly on the whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerday.llm.common import drop_tables, shared_table, words
from ledgerday.llm.minhash import WordRuns
from ledgerday.llm.near import count_links, near_classes

#: Words in a shingle, and the similarity from which documents are linked.
SHINGLE = 5
SIMILARITY = 0.8
#: A pair of similarity 0.8 shares no bucket with probability (1 - 0.8^6)^32 = 6e-5, one of 0.85 with
#: 2e-7; texts that share a passage (0.3) rarely meet.
BANDS, ROWS = 32, 6
#: Signature values besides the bands', values compared at a time, and the tolerance.
EXTRA, STEP, TOLERANCE = 32, 16, 1e-7


def shingler():
    return WordRuns(words, SHINGLE)


def least_matches(n: int, threshold: float = SIMILARITY, tolerance: float = TOLERANCE) -> int:
    """The fewest matches among ``n`` values with which P(similarity >= threshold) isn't below the tolerance.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), whose upper
    tail is a binomial sum.
    """
    tail = 0.0
    for m in range(n + 1):
        tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if tail >= tolerance:
            return m
    return n + 1


def prune(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) that no step rules out."""
    size = BANDS * ROWS + EXTRA
    steps = [(n, least_matches(n)) for n in range(STEP, size + 1, STEP)]
    needed = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sigs = signed.select("id", "sig").join(needed, "id", "left_semi").dropDuplicates(["id"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, size) for i in (2, 3)
            )
            alive, matches = np.arange(len(a)), np.zeros(len(a), int)
            for n, least in steps:
                matches = matches + (a[alive, n - STEP : n] == b[alive, n - STEP : n]).sum(1)
                alive, matches = alive[matches >= least], matches[matches >= least]
            yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(alive)) for i in (0, 1)], names=["a", "b"])

    left = sigs.select(F.col("id").alias("a"), F.col("sig").alias("sig_a"))
    right = sigs.select(F.col("id").alias("b"), F.col("sig").alias("sig_b"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "sig_a", "sig_b")
    return rows.mapInArrow(compare, "a long, b long")


def _classes(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``doc, id`` of every row (``id``: the text's hash, null without a text), ``id, class`` of linked texts,
    and ``id, text`` of those that share a bucket."""
    rows = docs.select(
        F.col(id_col).alias("doc"), F.when(F.length(F.col(text_col)) > 0, F.col(text_col)).alias("text")
    )
    rows = rows.withColumn("id", F.when(F.col("text").isNotNull(), F.xxhash64("text")))
    classes, texts = near_classes(
        rows.where("id is not null").select("id", "text"), shingler, SIMILARITY, BANDS, ROWS, "docs", EXTRA, prune
    )
    return rows.select("doc", "id"), classes, texts


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, class_id, n_copies, n_links`` of every row.

    Two texts are linked if the Jaccard similarity of their sets of five-word
    runs (lower-cased words; a shorter text is one run) is 0.8 or more.
    ``class_id`` is the smallest id of the row's class: the connected component
    of the links, equal texts included.  ``n_copies`` counts the rows with the
    same text; ``n_links`` the different texts that it is linked to, all of
    them: within a class every pair is compared.

    A null or empty text is a class of its own with its id (null if that is
    null), with no links.  Texts without a word are linked to equal texts only.
    Repeated ids and rows: each row counts.  Empty table: no rows.  Other
    columns are ignored.  Texts are told apart by a 64-bit hash.
    """
    slim, classes, shared = _classes(docs, id_col, text_col)
    degree = count_links(classes, shared, shingler, SIMILARITY)
    drop_tables(shared)
    copies = slim.where("id is not null").groupBy("id").agg(F.count("*").alias("n_copies"), F.min("doc").alias("first"))
    texts = (
        copies.join(classes, "id", "left").join(degree, "id", "left")
        .select("id", "n_copies", "first", F.coalesce("class", "id").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    named = texts.groupBy("class").agg(F.min("first").alias("class_id"))
    texts = texts.join(named, "class").select("id", "n_copies", "n_links", "class_id")
    return slim.join(texts, "id", "left").select(
        F.col("doc").alias(id_col),
        F.when(F.col("id").isNull(), F.col("doc")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeats: bool = True) -> DataFrame:
    """``docs``, all columns, with the row of the smallest (id, text hash) of each class (rows without a text stay).

    Null ids come last, so a class has a row without an id only if all its ids
    are null.  Of rows with the same id and text as the one that stays, all
    stay with ``repeats``, else one of them, whichever its other columns are.
    """
    rows, classes, shared = _classes(docs, id_col, text_col)
    drop_tables(shared)
    texts = rows.where("id is not null").groupBy("doc", "id").agg(F.count("*").alias("n"))
    place = F.struct(F.col("doc").isNull().alias("last"), "doc", "id", "n")
    chosen = (
        texts.join(classes, "id", "left").groupBy(F.coalesce("class", "id").alias("class")).agg(F.min(place).alias("x"))
        .select(F.col("x.doc").alias("__doc"), F.col("x.id").alias("__id"), F.col("x.n").alias("__n"))
    )
    chosen = shared_table(chosen, "chosen")
    keyed = docs.withColumn("__hash", F.when(F.length(F.col(text_col)) > 0, F.xxhash64(F.col(text_col))))

    def those(places: DataFrame) -> DataFrame:
        return keyed.join(places, (F.col("__hash") == F.col("__id")) & F.col(id_col).eqNullSafe(F.col("__doc")), "left_semi")

    kept = keyed.where("__hash is null").union(those(chosen.where("__n = 1") if not repeats else chosen))
    if not repeats:
        kept = kept.union(those(chosen.where("__n > 1")).dropDuplicates([id_col, "__hash"]))
    return kept.drop("__hash")
