"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

A test item's seeds are its three-word runs, and those with one word between
left out, so that an edited word doesn't break every run that spans it.  Of the
grams that the corpus holds, those that are common compared with the item's
others are no seeds, whatever the counts are: an item that half of the corpus
copies has seeds too.  Where an item's seeds meet in a document, the words
around them are aligned with the item.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerday.llm.common import shared_table, words

#: Places of a gram's words.
PATTERNS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
#: Items with fewer words are searched for word by word: only a verbatim copy tells anything.
MIN_ALIGNED = 8
#: A document with a verbatim copy of an item of fewer words isn't dropped for it.
MIN_DROPPED = 5
#: How many times as many documents as the median of an item's grams that occur may hold a seed.
RARE = 16
#: Seeds that must meet within an item's length, and the share of its words that they must be of.
MIN_SEEDS, MIN_COVERED = 2, 0.25
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
#: Alignment score per item word from which a document counts as contaminated
#: (a copy with a third of its words replaced, or half of the item).
MIN_SCORE = 0.5
#: Item words in one broadcast; a larger benchmark is searched in blocks of this size.
BLOCK_WORDS = 1_000_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Block:
    """Items of one broadcast as word numbers (from 1) and their grams as sorted keys."""

    ids: list
    items: list[np.ndarray]
    vocabulary: dict[bytes, int]
    grams: np.ndarray = None
    places: dict[int, list[tuple[int, tuple]]] = field(default_factory=dict)  # seed -> (item, places of its words)
    short: dict[int, dict[int, list[int]]] = field(default_factory=dict)  # number of words -> key of all -> items

    @classmethod
    def of(cls, rows: list[tuple]) -> "Block":
        texts = [(i, words(t)) for i, t in rows]
        texts = [(i, ws) for i, ws in texts if ws]
        vocabulary = {w: n for n, w in enumerate(sorted({w for _, ws in texts for w in ws}), 1)}
        block = cls([i for i, _ in texts], [np.array([vocabulary[w] for w in ws], np.int64) for _, ws in texts], vocabulary)
        keys = [keys for item in block.items if len(item) >= MIN_ALIGNED for keys, _ in block.keys(item)]
        block.grams = np.unique(np.concatenate(keys)) if keys else np.empty(0, np.int64)
        for n, item in enumerate(block.items):
            if len(item) < MIN_ALIGNED:
                key = int(block.whole_keys(item, len(item))[0])
                block.short.setdefault(len(item), {}).setdefault(key, []).append(n)
        return block

    def keys(self, numbers: np.ndarray) -> Iterator[tuple[np.ndarray, tuple]]:
        """For each pattern a key for each place, and the pattern; -1 where a word isn't in the vocabulary."""
        base = len(self.vocabulary) + 1
        for kind, pattern in enumerate(PATTERNS):
            m = max(len(numbers) - pattern[-1], 0)
            key, known = np.full(m, kind, np.int64), np.ones(m, bool)
            for i in pattern:
                part = numbers[i : i + m]
                key = key * base + part
                known &= part > 0
            yield np.where(known, key, -1), pattern

    @staticmethod
    def whole_keys(numbers: np.ndarray, n: int) -> np.ndarray:
        """A hash of the ``n`` words from each place on."""
        m = len(numbers) - n + 1
        key = np.zeros(max(m, 0), np.uint64)
        with np.errstate(over="ignore"):
            for i in range(n if m > 0 else 0):
                key = (key + numbers[i : i + m].astype(np.uint64) + np.uint64(1)) * _FACTOR
                key ^= key >> np.uint64(29)
        return key

    def numbers(self, text: str | None) -> np.ndarray:
        number = self.vocabulary.get
        return np.array([number(w, 0) for w in words(text)], np.int64)

    def grams_in(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and gram numbers of the block's grams in a text."""
        places, grams = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for keys, _ in self.keys(numbers) if len(self.grams) else ():
            at = np.flatnonzero(keys >= 0)
            gram = np.minimum(np.searchsorted(self.grams, keys[at]), len(self.grams) - 1)
            hit = self.grams[gram] == keys[at]
            places.append(at[hit])
            grams.append(gram[hit])
        return np.concatenate(places), np.concatenate(grams)

    def choose_seeds(self, frequency: np.ndarray) -> None:
        """Of each item's grams that occur (``frequency``: documents that hold it) those that aren't common among them."""
        places = defaultdict(list)
        for n, item in enumerate(self.items):
            if len(item) < MIN_ALIGNED:
                continue
            own = [(g, tuple(at + i for i in pattern)) for keys, pattern in self.keys(item)
                   for at, g in enumerate(np.searchsorted(self.grams, keys).tolist())]
            occurring = [frequency[g] for g in {g for g, _ in own} if frequency[g]]
            most = RARE * np.median(occurring) if occurring else 0
            for g, at in own:
                if 0 < frequency[g] <= most:
                    places[g].append((n, at))
        self.places = dict(places)

    def matches(self, text: str | None) -> list[tuple]:
        """``(item id, score, first word, end word)`` of the items that the text holds, each at its best place."""
        numbers = self.numbers(text)
        by_item = defaultdict(list)
        for at, gram in zip(*(x.tolist() for x in self.grams_in(numbers))):
            for n, place in self.places.get(gram, ()):
                by_item[n].append((at, gram, place))
        found = self._verbatim(numbers)
        for n, hits in sorted(by_item.items()):
            item = self.items[n]
            best = (0.0, 0, 0)
            for lo, hi in _meeting(hits, len(item)):
                start = max(0, lo - len(item))
                window = numbers[start : hi + PATTERNS[-1][-1] + 1 + len(item)]
                # No alignment has more matches than the item has words that stand there at all.
                if np.isin(item, window).mean() < MIN_SCORE:
                    continue
                score, first, end = align(item, window)
                best = max(best, (score / (MATCH * len(item)), start + first, start + end), key=lambda b: b[0])
            if best[0] >= MIN_SCORE:
                found.append((self.ids[n], *best))
        return found

    def _verbatim(self, numbers: np.ndarray) -> list[tuple]:
        """The short items that stand in the text, each at its first place."""
        found = {}
        for n, items in self.short.items():
            keys = self.whole_keys(numbers, n)
            for at in np.flatnonzero(np.isin(keys, np.fromiter(items, np.uint64, len(items)))).tolist():
                for i in items[int(keys[at])]:
                    if i not in found and np.array_equal(numbers[at : at + n], self.items[i]):
                        found[i] = (self.ids[i], 1.0, at, at + n)
        return list(found.values())


def _meeting(hits: list[tuple[int, int, tuple]], reach: int) -> Iterator[tuple[int, int]]:
    """First and last places of hits that lie within ``reach`` of each other, if they are of enough seeds and words."""
    run: list[tuple[int, int, tuple]] = []
    for hit in [*sorted(hits), (np.inf, -1, ())]:
        if run and hit[0] - run[-1][0] > reach:
            covered = {i for _, _, places in run for i in places}
            if len({g for _, g, _ in run}) >= MIN_SEEDS and len(covered) >= MIN_COVERED * reach:
                yield run[0][0], run[-1][0]
            run = []
        run.append(hit)


def _scores(item: np.ndarray, window: np.ndarray) -> tuple[float, int]:
    """The best local alignment's score and the place in ``window`` after its last word."""
    if not len(window):
        return 0.0, 0
    slope = -GAP * np.arange(1, len(window) + 1)
    row, best, end = np.zeros(len(window) + 1), 0.0, 0
    for word in item:
        step = np.maximum(row[:-1] + np.where(window == word, MATCH, MISMATCH), row[1:] + GAP)
        step = np.maximum(step, 0.0)
        # A gap along the window costs in proportion, so the best way to reach each place is a running maximum.
        step = np.maximum.accumulate(step + slope) - slope
        row = np.concatenate(([0.0], step))
        i = int(step.argmax())
        if step[i] > best + 1e-9:
            best, end = float(step[i]), i + 1
    return best, end


def align(item: np.ndarray, window: np.ndarray) -> tuple[float, int, int]:
    """Smith-Waterman: the best score, and the first and end places of its words in ``window``."""
    score, end = _scores(item, window)
    _, length = _scores(item[::-1], window[:end][::-1])
    return score, end - length, end


def item_texts(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item, text_id, text`` of the items with a text; equal texts have one ``text_id``."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).where("text is not null")
    return items.select("item", F.xxhash64("text").alias("text_id"), "text")


def blocks(items: DataFrame) -> Iterator[Block]:
    """The different texts of ``items`` in blocks of about ``BLOCK_WORDS`` words, each small enough to broadcast."""
    texts = items.select("text_id", "text").dropDuplicates(["text_id"])
    texts = shared_table(texts, "benchmark-texts")
    n_words = texts.agg(F.sum(F.size(F.split("text", r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+")))).first()[0] or 0
    count = -(-n_words // BLOCK_WORDS)
    for i in range(count):
        rows = texts.where(F.pmod("text_id", F.lit(count)) == i).orderBy("text_id").collect()  # one block
        block = Block.of([tuple(r) for r in rows])
        if block.items:
            yield block


def gram_frequency(docs: DataFrame, block: Block, text_col: str = "text") -> np.ndarray:
    """For each of the block's grams, the documents of the whole corpus that hold it."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        held = np.zeros(len(own.grams), np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                _, gram = own.grams_in(own.numbers(text))
                held[np.unique(gram)] += 1
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], names=["gram", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "gram long, n long")
    frequency = np.zeros(len(block.grams), np.int64)
    for gram, n in rows.groupBy("gram").agg(F.sum("n")).collect():  # at most a row per gram of the block
        frequency[gram] = n
    return frequency


def seeded_blocks(docs: DataFrame, items: DataFrame, text_col: str = "text") -> list[Block]:
    out = []
    for block in blocks(items):
        block.choose_seeds(gram_frequency(docs, block, text_col))
        out.append(block)
    return out


_MATCH = "struct<text_id:long,score:double,first_word:long,end_word:long>"


def matches_in(docs: DataFrame, block: Block, text: Column, least: int = 1) -> Column:
    """The block's items of ``least`` words or more that a text holds, as a column over ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    @F.pandas_udf(f"array<{_MATCH}>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own, names = shared.value, ("text_id", "score", "first_word", "end_word")
        sizes = {i: len(item) for i, item in zip(own.ids, own.items)}
        for texts in batches:
            yield pd.Series([[dict(zip(names, m)) for m in own.matches(t) if sizes[m[0]] >= least] for t in texts], dtype=object)

    return find(text)


def contaminations(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, item_id, score, first_word, end_word``: a row for each document and test item that it holds.

    Words are lower-cased ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; ``score`` (0.5
    to 1) is the best local alignment's score per item word, with 1 for a
    match and -0.5 for a mismatch or gap.  Items of fewer than ``MIN_ALIGNED``
    words are found verbatim only.  The corpus is scanned twice for each
    block of the benchmark's different texts: once for the grams' frequencies, once for matches,
    which are aligned where the text lies; no text of the corpus is shuffled.

    Null or empty text on either side, or one without a word: no rows.  Null or
    repeated ids and repeated items: a row for each.  Empty tables: no rows.
    Other columns are ignored.
    """
    items = item_texts(benchmark)
    parts = [
        docs.select(F.col(id_col), F.explode(matches_in(docs, b, F.col(text_col))).alias("m")) for b in seeded_blocks(docs, items, text_col)
    ]
    found = docs.sparkSession.createDataFrame([], f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, m {_MATCH}")
    for part in parts:
        found = found.union(part)
    return found.select(id_col, "m.*").join(items.select("text_id", F.col("item").alias("item_id")), "text_id").select(
        id_col, "item_id", "score", "first_word", "end_word"
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", least: int = MIN_DROPPED) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no test item of ``least`` words or more."""
    kept = docs
    for block in seeded_blocks(docs, item_texts(benchmark), text_col):
        kept = kept.where(F.size(matches_in(docs, block, F.col(text_col), least)) == 0)
    return kept
