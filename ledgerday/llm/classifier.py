"""Supervised subword embeddings: a document's vector is the mean of its words' and
character n-grams' learned vectors; a softmax layer gives the label.

Training is numpy stochastic gradient descent on a bounded sample of labelled
documents.  As the output layer is linear in the mean, a hash bucket's share in
the logit difference is one number, so scoring adds up numbers per word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerday.llm.common import blank_separated

#: Labelled documents that a model is fitted on at most, taken by hash of their id.
MAX_TRAINING_DOCS = 2000


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 16
    dims: int = 8
    shortest: int = 2  # character n-grams, in bytes of the word between its marks
    longest: int = 4
    batch: int = 16
    rate: float = 0.5
    #: Training ends when an epoch's mean loss is this small, when ``patience`` epochs have not
    #: lowered it by a hundredth, or after ``steps`` batches.
    loss: float = 0.03
    patience: int = 8
    steps: int = 4000
    seed: int = 7


_FACTOR = np.uint32(16777619)
#: The bucket of the word pair "a word and the same again", whichever the word, is that of this word.
_REPEATED = b"\0same again"
#: A repeated word's weight in the mean: about that of a word's n-grams together.
REPEAT_WEIGHT = 16
#: Texts that are scored at a time.
TEXTS = 256
#: Different words whose features a task holds.
HELD_WORDS = 400_000


def word_features(words: list[bytes], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' n-grams (words are marked at both ends) and of the whole words, and whose each is."""
    marked = [b"<" + w + b">" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    data = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint32)
    ends = np.cumsum(sizes)
    word = np.repeat(np.arange(len(marked)), sizes)
    left = ends[word] - np.arange(len(data))  # bytes up to the word's end
    buckets, owners = [], []
    h = np.full(len(data), 2166136261, np.uint32)
    with np.errstate(over="ignore"):
        for n in range(1, s.longest + 1):
            m = len(data) - n + 1
            h = (h[: max(m, 0)] ^ data[n - 1 :]) * _FACTOR
            if n >= s.shortest:
                at = np.flatnonzero(left[: len(h)] >= n)
                x = h[at] + np.uint32(n)
                buckets.append((x ^ x >> np.uint32(15)) * _FACTOR >> np.uint32(8))
                owners.append(word[at])
        # Whole words: a weighted sum of their bytes, weights by place.
        place = np.arange(len(data)) - (ends - sizes)[word]
        weight = (place.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
        x = (data + np.uint32(7)) * (weight ^ weight >> np.uint32(13)) * _FACTOR
        whole = np.add.reduceat(x ^ x >> np.uint32(16), ends - sizes) if len(marked) else np.empty(0, np.uint32)
        buckets.append((whole ^ whole >> np.uint32(15)) * _FACTOR >> np.uint32(8))
    owners.append(np.arange(len(marked)))
    return (np.concatenate(buckets) % np.uint32(s.buckets)).astype(np.int64), np.concatenate(owners)


def repeat_bucket(s: Settings) -> int:
    return int(word_features([_REPEATED], s)[0][-1])


def _repeats(ws: list[bytes]) -> int:
    return sum(map(bytes.__eq__, ws, ws[1:]))


def features(text: str | None, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and their shares in the text's mean."""
    ws = blank_separated(text)
    counts = Counter(ws)
    buckets, owners = word_features(list(counts), s)
    weights = np.fromiter(counts.values(), np.float64, len(counts))[owners]
    if n := _repeats(ws):
        buckets, weights = np.append(buckets, repeat_bucket(s)), np.append(weights, n * REPEAT_WEIGHT)
    ids, place = np.unique(buckets, return_inverse=True)
    n = np.bincount(place, weights, len(ids))
    return ids, n / max(n.sum(), 1.0)


class SubwordClassifier:
    """``logit[b]``: what a feature in bucket b adds to the logit of label 1."""

    def __init__(self, logit: np.ndarray, bias: float, settings: Settings):
        self.logit, self.bias, self.settings = logit, bias, settings

    @classmethod
    def fit(cls, examples: list[tuple[np.ndarray, np.ndarray]], labels: list[int], s: Settings = Settings()):
        """Mini-batch gradient descent on the softmax cross-entropy until it no longer falls (see :class:`Settings`).

        Without examples of both labels every score is the share of label 1 (0.5 without any).
        """
        y = np.asarray(labels, np.int64)
        if len(set(labels)) < 2:
            p = float(y.mean()) if len(y) else 0.5
            p = min(max(p, 1e-3), 1 - 1e-3)
            return cls(np.zeros(s.buckets, np.float32), float(np.log(p / (1 - p))), s)
        rng = np.random.default_rng(s.seed)
        vectors = rng.uniform(-1 / s.dims, 1 / s.dims, (s.buckets, s.dims))
        out = rng.uniform(-0.1, 0.1, (s.dims, 2))
        bias = np.zeros(2)
        step, best, waited = 0, np.inf, 0
        while step < s.steps and waited < s.patience:
            loss, order = 0.0, rng.permutation(len(y))
            for i in range(0, len(order), s.batch):
                rate = s.rate * (1 - 0.9 * min(step / s.steps, 1))
                step += 1
                rows = order[i : i + s.batch]
                hidden = np.stack([w @ vectors[ids] for ids, w in (examples[r] for r in rows)])
                z = hidden @ out + bias
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                loss -= float(np.log(np.maximum(p[np.arange(len(rows)), y[rows]], 1e-12)).sum())
                p[np.arange(len(rows)), y[rows]] -= 1
                back = p @ out.T
                out -= rate * hidden.T @ p / len(rows) * 10
                bias -= rate * p.mean(0)
                for r, g in zip(rows, back):
                    ids, w = examples[r]
                    vectors[ids] -= (rate * 20) * w[:, None] * g
            loss /= len(y)
            waited = 0 if loss < 0.99 * best else waited + 1
            best = min(best, loss)
            if loss <= s.loss:
                break
        logits = vectors @ out
        return cls((logits[:, 1] - logits[:, 0]).astype(np.float32), float(bias[1] - bias[0]), s)

    def scorer(self):
        """texts -> probabilities of label 1."""
        s, table = self.settings, self.logit.astype(np.float64)
        repeated = table[repeat_bucket(s)]
        number: dict[bytes, int] = {}  # of words that were met, emptied when there are many
        sums, counts = np.empty(0), np.empty(0)  # each one's sum of logits and number of features

        def score(texts: list[str | None]) -> list[float]:
            nonlocal sums, counts
            split = [blank_separated(t) for t in texts]
            if len(number) > HELD_WORDS:
                number.clear()
                sums, counts = np.empty(0), np.empty(0)
            new = list({w for ws in split for w in ws if w not in number})
            if new:
                buckets, owners = word_features(new, s)
                number.update(zip(new, range(len(number), len(number) + len(new))))
                sums = np.append(sums, np.bincount(owners, table[buckets], len(new)))
                counts = np.append(counts, np.bincount(owners, minlength=len(new)))
            out = []
            for ws in split:
                ids = np.fromiter(map(number.__getitem__, ws), np.int64, len(ws))
                again = REPEAT_WEIGHT * np.count_nonzero(ids[1:] == ids[:-1])
                z = self.bias + (sums[ids].sum() + again * repeated) / max(counts[ids].sum() + again, 1.0)
                out.append(float(1 / (1 + np.exp(-z))))
            return out

        return score


def crc32_of_id(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary"))


def fit_quality(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), max_docs: int = MAX_TRAINING_DOCS):
    """A model of ``labels.quality`` from the whole texts of at most ``max_docs`` labelled
    documents whose crc32(doc_id) mod 5 isn't 0.

    The sample is the first ``max_docs`` by hash of the id, so it doesn't
    depend on partitioning; only its features (the sample's, bounded) reach the
    driver.  Rows with a null id, or a label other than 0 and 1, are left out; of several labels of
    a document the largest counts; of several texts the first by hash.
    """
    rows = sorted(training_rows(docs, labels, settings, max_docs).collect(), key=lambda r: r["doc_id"])
    examples = [(np.frombuffer(r["ids"], "<i4"), np.frombuffer(r["shares"], "<f4")) for r in rows]
    return SubwordClassifier.fit(examples, [int(r["quality"]) for r in rows], settings)


def training_rows(docs: DataFrame, labels: DataFrame, settings: Settings, max_docs: int) -> DataFrame:
    """``doc_id, quality, ids, shares``: a row for each id of the sample that ``docs`` has, with its features as bytes."""
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(crc32_of_id(F.col("doc_id")) % 5 != 0)
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
    )
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    sample = known.orderBy(*order).limit(max_docs)
    s = settings

    @F.pandas_udf("ids binary, shares binary")
    def of_text(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            pairs = (features(t, s) for t in texts)
            rows = [(ids.astype("<i4").tobytes(), w.astype("<f4").tobytes()) for ids, w in pairs]
            yield pd.DataFrame(rows, columns=["ids", "shares"])

    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most max_docs short rows
    # Combined map-side: however often an id is repeated, a task passes on one text of it.
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first")
    one = rows.groupBy("doc_id").agg(F.max("quality").alias("quality"), least)
    return one.select("doc_id", "quality", of_text("first.text").alias("f")).select("doc_id", "quality", "f.*")


def quality_score(docs: DataFrame, model: SubwordClassifier, text: Column) -> Column:
    """The probability of label 1 as a column over ``docs`` (null and empty texts: that of the bias)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is a setting

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = shared.value.scorer()
        for texts in batches:
            rest = iter(texts)
            scores: list[float] = []
            while part := list(islice(rest, TEXTS)):
                scores += of(part)
            yield pd.Series(scores, dtype="float64")

    return score(text)


def classify(docs: DataFrame, model: SubwordClassifier, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, score, predicted`` of every row, from its whole text.

    ``predicted`` is 1 from ``threshold`` on; ``held_out`` marks the fifth of
    the ids that no model is fitted on.  Null or empty text: the model's bias.
    Null id: not held out.  Repeated rows: each is scored alike.  Empty table:
    no rows.  Other columns are ignored, and no label, language, source or id
    goes into a score.
    """
    return docs.select(
        F.col(id_col),
        F.coalesce(crc32_of_id(F.col(id_col)) % 5 == 0, F.lit(False)).alias("held_out"),
        quality_score(docs, model, F.col(text_col)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
