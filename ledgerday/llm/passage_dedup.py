"""Substring dedup by paragraph MinHash: passages that repeat across or within documents.

Paragraphs are cut by content: one begins at each word whose hash is the
smallest of the ``REACH`` words on either side, so the copies of a passage have
the same paragraphs wherever they were pasted, but for a few words at the edges
and around edits.  Paragraphs that collide in a band of their MinHash signatures
are checked by exact Jaccard similarity of their character runs and joined into
classes.  Runs of repeated paragraphs of a text make passages, whose ends are
found by aligning the words around them with those around another place.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerday.llm.common import drop_tables, shared_table
from ledgerday.llm.minhash import CharRuns, word_places
from ledgerday.llm.near import near_classes, small

#: Words on either side of a paragraph's first word, which has the smallest hash of them; and words that a paragraph has at most.
REACH, LONGEST = 5, 64
#: Code points of a shingle, and the similarity of two paragraphs: two edited words of eleven.
SHINGLE, SIMILARITY = 7, 0.4
#: A pair of similarity 0.9 is missed with probability (1 - 0.9^4)^6 = 0.002, one of 0.67 (one word of
#: eleven edited) with 0.26: a passage has several paragraphs.
BANDS, ROWS = 6, 4
#: Words of a paragraph that is compared, and of a passage that is reported, at least.
MIN_PARAGRAPH, MIN_PASSAGE = 5, 16
#: Paragraphs between two repeated ones that still belong to one passage, and those on either side of a run that are aligned.
GAP, AROUND = 1, 4
#: Where a paragraph stands in its text (see :func:`paragraphs_of`).
SPAN = ("begin", "size", "before", "after")
#: Words by which two alignments may be apart, and how much worse than the best one an alignment may get.
BAND, DROP = 8, 8
#: Texts that are cut at a time, and bytes of them: few, so that the work stays in the processor's cache.
TEXTS, TEXT_BYTES = 32, 4_000_000
#: Pairs of beginnings that are aligned at a time.
PAIRS = 2048
_WORD = re.compile(r"[^ \t-\r]+")
# Lowers A-Z and makes every blank a space.
_LOWER = bytes(c + 32 if "A" <= chr(c) <= "Z" else 32 if 9 <= c <= 13 else c for c in range(256))


def least_in_reach(hashes: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Which hashes are smaller than the ``reach`` before them and not larger than those behind."""
    n = len(hashes)
    padded = np.pad(hashes, reach, constant_values=np.iinfo(np.uint64).max)
    least = np.ones(n, bool)
    for k in range(1, reach + 1):
        least &= hashes < padded[reach - k : reach - k + n]
        least &= hashes <= padded[reach + k : reach + k + n]
    return least


def cut(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts joined, and of each paragraph its first byte there, its text's number and its first and end words in it."""
    joined = b"\n".join(texts).translate(_LOWER)
    starts, _, hashes = word_places(np.frombuffer(joined, np.uint8))
    own = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    # Between two texts stand as many largest hashes as a word can reach.
    first = np.flatnonzero(np.diff(own, prepend=-1))
    rank = np.zeros(len(own), np.int64)
    rank[first] = 1
    spread = np.arange(len(own)) + REACH * (np.cumsum(rank) - 1)
    apart = np.full(spread[-1] + 1 if len(spread) else 0, np.iinfo(np.uint64).max, np.uint64)
    apart[spread] = hashes
    begins = least_in_reach(apart)[spread]
    begins[first] = True
    at = np.flatnonzero(begins)
    ends = np.append(at[1:], len(own))
    # A paragraph that would be too long is cut at a fixed length.
    parts = -(-(ends - at) // LONGEST)
    which = np.repeat(np.arange(len(at)), parts)
    step = np.arange(len(which)) - (np.cumsum(parts) - parts)[which]
    low = at[which] + LONGEST * step
    high = np.minimum(low + LONGEST, ends[which])
    text_first = first[np.cumsum(rank)[low] - 1] if len(low) else low
    return joined, starts[low], own[low], low - text_first, high - text_first


def _shingler():
    return CharRuns(SHINGLE)


def extensions(own: list[list[str]], other: list[list[str]]) -> np.ndarray:
    """For each pair of texts, how many of the first words of ``own`` belong to what it has in common with ``other`` from the first
    word on: the longest best-scoring alignment of two beginnings (1 a match, -1 an edited word)."""
    numbers = defaultdict(count().__next__)
    words = []
    for texts, before, behind, filler in ((own, 1, 0, -1), (other, BAND + 1, BAND + 1, -2)):
        sizes = np.array([len(t) for t in texts], np.int64)
        table = np.full((len(texts), before + int(max(sizes, default=0)) + behind), filler, np.int32)
        flat = map(numbers.__getitem__, chain.from_iterable(texts))
        table[:, before:][np.arange(table.shape[1] - before) < sizes[:, None]] = np.fromiter(flat, np.int32, sizes.sum())
        words.append((table, sizes))
    (a, n_own), (b, n_other) = words
    b = np.pad(b, ((0, 0), (0, max(0, a.shape[1] + 2 * BAND + 1 - b.shape[1]))), constant_values=-2)
    length = np.zeros(len(a), np.int64)
    # A row has the scores of the first i own words with i - BAND to i + BAND of the other's; all pairs at once.
    alive, best = np.arange(len(a)), np.zeros(len(a), np.int32)
    place = np.arange(-BAND, BAND + 1, dtype=np.int32)
    none = np.int32(-1 << 20)
    row = np.where((place >= 0) & (place <= n_other[:, None]), -place, none)
    for i in range(1, a.shape[1]):
        on = (n_own[alive] >= i) & (n_other[alive] >= i - BAND)
        if not on.all():
            alive, best, row = alive[on], best[on], row[on]
        if not len(alive):
            break
        row_before = row
        equal = a[alive, i][:, None] == b[alive, i : i + len(place)]
        row = row_before + np.where(equal, np.int32(1), np.int32(-1))
        row[:, place + i < 1] = none
        np.maximum(row[:, :-1], row_before[:, 1:] - 1, out=row[:, :-1])
        row = np.maximum.accumulate(row + place, axis=1) - place
        row[(place + i < 0) | (place + i > n_other[alive][:, None])] = none
        top = row.max(1)
        more = top > best
        length[alive[more]] = i
        best = np.maximum(best, top)
        on = top >= best - DROP
        if not on.all():
            alive, best, row = alive[on], best[on], row[on]
    return length


def extension(own: list[str], other: list[str]) -> int:
    """:func:`extensions` of one pair."""
    return int(extensions([own], [other])[0])


def _places(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, row, place, text`` of the rows with a text."""
    row = F.xxhash64(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), row.alias("row"), F.col(text_col).alias("text")).where("text is not null")
    return rows.select("doc_id", "row", F.xxhash64("doc_id", "row").alias("place"), "text")


def paragraphs_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row, place, unit, from_word, end_word, begin, size, before, after, id, text`` of each paragraph.

    ``row`` (a hash of the text) tells input rows with equal ids apart, ``place`` (a hash) names the two; ``id`` is
    null where the paragraph is too short to be compared.  ``begin`` and ``size`` are bytes of the text; ``before`` has
    those of the ``AROUND`` paragraphs before it, ``after`` its own and those of the ``AROUND`` behind it.
    """
    doc_type = docs.schema[id_col].dataType
    rows = _places(docs, id_col, text_col)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo = 0
            while lo < batch.num_rows:
                texts, size = [], 0
                while lo + len(texts) < batch.num_rows and len(texts) < TEXTS and size < TEXT_BYTES:
                    texts.append(batch.column(3)[lo + len(texts)].as_py().encode("utf-8", "surrogatepass"))
                    size += len(texts[-1])
                joined, first, own, low, high = cut(texts)
                part, lo = batch.slice(lo, len(texts)).select([0, 1, 2]), lo + len(texts)
                if not len(first):
                    continue
                every = np.arange(len(own))
                unit = every - np.searchsorted(own, own)
                last = np.searchsorted(own, own, side="right") - 1
                sizes = np.array([len(t) for t in texts])
                begin = first - (np.cumsum(sizes + 1) - sizes - 1)[own]
                end = np.where(every == last, sizes[own], np.append(begin[1:], 0))
                before = begin - begin[np.maximum(every - AROUND, every - unit)]
                after = end[np.minimum(every + AROUND, last)] - begin
                offsets = pa.py_buffer(np.append(first, len(joined)).astype(np.int32).tobytes())
                text = pc.ascii_rtrim(pa.StringArray.from_buffers(len(first), offsets, pa.py_buffer(joined)), " ")  # it begins with a word
                yield pa.RecordBatch.from_arrays(
                    [*part.take(pa.array(own)).columns, pa.array(unit, pa.int32()), pa.array(low, pa.int64()), pa.array(high, pa.int64()),
                     *(pa.array(x, pa.int32()) for x in (begin, end - begin, before, after)), text],
                    names=["doc_id", "row", "place", "unit", "from_word", "end_word", *SPAN, "text"],
                )

    units = rows.mapInArrow(split, f"doc_id {doc_type.simpleString()}, row long, place long, unit int, from_word long, end_word long, " + ", ".join(f"{c} int" for c in SPAN) + ", text string")
    long = F.col("end_word") - F.col("from_word") >= MIN_PARAGRAPH
    return units.withColumn("id", F.when(long, F.xxhash64("text")))


def repeated_paragraphs(units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The paragraphs (:func:`paragraphs_of`, without the text) whose class has several places, with
    ``class``, ``kept`` (the class's first place by (doc_id, row, unit)) and ``other``: another place (``place`` and
    ``SPAN``) of the class.  And the table that they are read from, for the caller to drop."""
    long = units.where("id is not null")
    classes, shared = near_classes(long.select("id", "text"), _shingler, SIMILARITY, BANDS, ROWS, "paragraphs")
    drop_tables(shared)
    # Most paragraphs stand in one row only and have no class: a count sorts them out.
    several = long.groupBy("id").count().where("count > 1")
    sought = several.select("id").join(classes, "id", "full").select("id", F.coalesce("class", "id").alias("class"))
    sought = shared_table(sought, "repeated-paragraphs")
    placed = long.select("doc_id", "row", "place", "unit", "from_word", "end_word", *SPAN, "id").join(small(sought), "id").drop("id").dropDuplicates(["place", "unit"])
    placed = shared_table(placed, "paragraph-places")
    drop_tables(sought)
    where = F.struct("doc_id", "row", "unit", "place", *SPAN)
    many = placed.groupBy("class").agg(F.min(where).alias("first"), F.max(where).alias("last")).where("first < last")
    marked = placed.join(many, "class").withColumn("kept", where.eqNullSafe(F.col("first")))
    other = F.when(F.col("kept"), F.col("last")).otherwise(F.col("first"))
    found = marked.withColumn("other", other).select(
        *placed.columns, "kept", F.struct(*(F.col(f"other.{c}").alias(c) for c in ("place", *SPAN))).alias("other")
    )
    return found, placed


def _beginnings(texts: DataFrame, spots: DataFrame) -> DataFrame:
    """``at, low, high, text``: bytes ``low`` to ``high`` (lower-cased) of the text ``at``, for each of ``spots``; a text's are cut at once."""
    own = spots.groupBy("at").agg(F.collect_set(F.struct("low", "high")).alias("spots"))  # at most two a paragraph of the text

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, TEXTS):
                part = batch.slice(k, TEXTS)
                wanted = part.column(2)
                which = np.repeat(np.arange(len(wanted)), np.diff(wanted.offsets.to_numpy()))
                low, high = wanted.flatten().flatten()
                texts = [t.encode("utf-8", "surrogatepass").translate(_LOWER) for t in part.column(1).to_pylist()]
                cuts = [texts[i][x:y] for i, x, y in zip(which.tolist(), low.to_pylist(), high.to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(which)), low, high, pa.array(cuts, pa.binary()).view(pa.string())], names=["at", "low", "high", "text"]
                )

    rows = texts.join(own, "at").select("at", "text", "spots")
    return rows.mapInArrow(take, "at long, low int, high int, text string")


def removed_spans(parts: pa.ListArray, left: np.ndarray, right: np.ndarray) -> pa.ListArray:
    """The spans of words (from, end) of each run's paragraphs (``from_word, end_word, kept``) that aren't kept, neighbours
    joined; the run's first has ``left`` words from its end back, the last one ``right`` words from its beginning on."""
    sizes = np.diff(parts.offsets.to_numpy())
    first, last = np.cumsum(sizes) - sizes, np.cumsum(sizes) - 1
    flat = parts.flatten()
    low, high, kept = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("from_word", "end_word", "kept"))
    start, end = low.copy(), high.copy()
    start[first], end[last] = high[first] - left, low[last] + right
    begins, ends = ~kept, ~kept
    inner = np.ones(len(kept), bool)  # has one before it in its run
    inner[first] = False
    begins[1:] &= kept[:-1] | ~inner[1:]
    ends[:-1] &= kept[1:] | ~inner[1:]
    counts = np.add.reduceat(begins.astype(np.int32), first) if len(first) else np.empty(0, np.int32)
    spans = pa.StructArray.from_arrays([pa.array(start[begins]), pa.array(end[ends])], names=["from", "end"])
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), spans)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per passage: ``doc_id, row, first_word, end_word, n_words, n_paragraphs, removed, classes``.

    A passage is a run of repeated paragraphs of a text, with at most ``GAP``
    others between two, and the words at its ends that align with those at
    another place; it has ``MIN_PASSAGE`` blank-separated words or more.
    ``removed`` has the spans of words (from, end) that have an earlier place: those of the passage without the
    paragraphs that are their class's first.  ``classes`` are the paragraphs' classes (hashes of a member).

    Words are compared in lower case (A-Z).  Null and empty texts have no
    rows; null ids come first; rows repeated in full give one row.  Empty
    table: no rows.  Other columns are ignored.
    """
    units = shared_table(paragraphs_of(docs, id_col, text_col), "paragraph-texts")
    found, placed = repeated_paragraphs(units)
    order = Window.partitionBy("place").orderBy("unit")  # a text's own paragraphs
    new = F.col("unit") > F.coalesce(F.lag("unit").over(order), F.lit(-2 - GAP)) + 1 + GAP
    found = found.withColumn("run", F.sum(new.cast("int")).over(order))
    part = F.struct("unit", "from_word", "end_word", "kept", "class", "place", *SPAN, "other")
    runs = found.groupBy("doc_id", "row", "place", "run").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    runs = runs.withColumn("first", F.col("parts")[0]).withColumn("last", F.element_at("parts", -1))
    slim = F.transform("parts", lambda p: F.struct(*(p[c].alias(c) for c in ("from_word", "end_word", "kept", "class"))))
    runs = shared_table(runs.withColumn("parts", slim), "passage-runs")
    drop_tables(units, placed)
    # A run's first paragraph with those before it and its last with those behind, here and at another place of theirs.
    def beginning(p: str, side: str) -> Column:
        low = f"{p}.begin - {p}.before" if side == "left" else f"{p}.begin"
        high = f"{p}.begin + {p}.size" if side == "left" else f"{p}.begin + {p}.after"
        return F.struct(F.col(f"{p}.place").alias("at"), F.expr(low).alias("low"), F.expr(high).alias("high"))

    sides = F.array(*(
        F.struct(F.lit(side).alias("side"), beginning(p, side).alias("own"), beginning(f"{p}.other", side).alias("other"))
        for side, p in (("left", "first"), ("right", "last"))
    ))
    sides = runs.select("place", "run", F.explode(sides).alias("x")).select("place", "run", "x.*")
    texts = _places(docs, id_col, text_col).select(F.col("place").alias("at"), "text").dropDuplicates(["at"])
    cuts = shared_table(_beginnings(texts, sides.select("own.*").union(sides.select("other.*"))), "passage-ends")

    @F.pandas_udf("long")
    def extend(side: pd.Series, own: pd.Series, other: pd.Series) -> pd.Series:
        found = [np.empty(0, np.int64)]
        for k in range(0, len(side), PAIRS):
            part = slice(k, k + PAIRS)
            words = ([x.split()[:: -1 if s == "left" else 1] for s, x in zip(side[part], texts[part])] for texts in (own, other))
            found.append(extensions(*words))
        return pd.Series(np.concatenate(found))

    for which in ("own", "other"):
        sides = sides.select("*", f"{which}.*").join(cuts.withColumnRenamed("text", f"{which}_text"), ["at", "low", "high"]).drop("at", "low", "high")
    ends = sides.select("place", "run", "side", extend("side", "own_text", "other_text").alias("n"))
    ends = ends.groupBy("place", "run").agg(*(F.max(F.when(F.col("side") == side, F.col("n"))).alias(side) for side in ("left", "right")))
    stored, runs = runs, runs.join(ends, ["place", "run"], "left")
    # Words of the passage from the first paragraph's end back, and from the last one's first word on.
    whole = {"left": F.col("first.end_word") - F.col("first.from_word"), "right": F.col("last.end_word") - F.col("last.from_word")}
    runs = runs.withColumns({side: F.when(F.col(side) > 0, F.col(side)).otherwise(n) for side, n in whole.items()})

    @F.arrow_udf("array<struct<from:long,end:long>>")
    def gone(parts: pa.Array, left: pa.Array, right: pa.Array) -> pa.Array:
        return removed_spans(parts, *(x.to_numpy(zero_copy_only=False) for x in (left, right)))

    passages = runs.select(
        "doc_id", "row", "place", (F.col("first.end_word") - F.col("left")).alias("first_word"), (F.col("last.from_word") + F.col("right")).alias("end_word"),
        F.size("parts").cast("long").alias("n_paragraphs"), gone("parts", "left", "right").alias("removed"), F.col("parts.class").alias("classes"),
    )
    # Runs whose ends have met are one passage.
    order = Window.partitionBy("place").orderBy("first_word", "end_word")
    apart = F.col("first_word") > F.max("end_word").over(order.rowsBetween(Window.unboundedPreceding, -1))
    passages = passages.withColumn("n", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(order))
    passages = passages.groupBy("doc_id", "row", "place", "n").agg(
        F.min("first_word").alias("first_word"), F.max("end_word").alias("end_word"), F.sum("n_paragraphs").alias("n_paragraphs"),
        F.sort_array(F.flatten(F.collect_list("removed"))).alias("removed"), F.sort_array(F.flatten(F.collect_list("classes"))).alias("classes"),
    )
    passages = passages.withColumn("n_words", F.col("end_word") - F.col("first_word")).where(F.col("n_words") >= MIN_PASSAGE)
    passages = shared_table(passages.select("doc_id", "row", "first_word", "end_word", "n_words", "n_paragraphs", "removed", "classes"), "passages")
    drop_tables(stored, cuts)
    return passages


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without these spans of words, and without the blanks behind each of them."""
    places = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, at = [], 0
    for lo, hi in sorted(spans):
        out.append(text[at : max(at, places[lo])])
        at = max(at, places[hi])
    return "".join(out) + text[at:]


def cut_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every row and column, their texts without the removed spans."""
    cuts = repeated_passages(docs, id_col, text_col).where(F.size("removed") > 0)
    cuts = cuts.groupBy("doc_id", "row").agg(F.flatten(F.collect_list("removed")).alias("removed"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if s is None else without_words(t, [(x["from"], x["end"]) for x in s]) for t, s in zip(texts, spans)], dtype=object)

    joined = docs.alias("d").join(
        cuts.alias("x"),
        F.col(f"d.{id_col}").eqNullSafe(F.col("x.doc_id")) & (F.xxhash64(F.col(f"d.{text_col}")) == F.col("x.row")), "left",
    )
    text = cut(F.col(f"d.{text_col}"), F.col("x.removed"))
    return joined.select(*(text.alias(c) if c == text_col else F.col(f"d.`{c}`") for c in docs.columns))
