"""Classes of near-duplicate texts: banded MinHash candidates, exact check, components.

Two steps, however many members a bucket has.  First every member of a bucket
is paired with its most central one, which shares most buckets with others: in
a group of edited copies that is the text that they were made from, which is
nearer to each of them than they are to each other.  The pairs are checked
exactly and joined into classes; their number is that of the members.  Where a bucket still has
members of several classes, those outside its largest class are compared with all
others in a task (block by block if the bucket is large); only links that join
classes leave it.  So any two similar texts that share a bucket are of one class.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerday.llm.common import drop_tables, shared_table, streamed_groups
from ledgerday.llm.components import components
from ledgerday.llm.minhash import CharRuns, MinHash, WordRuns, band_keys, jaccard, shingle_sets

#: Makes what cuts whole texts into shingles (see :class:`~ledgerday.llm.minhash.WordRuns`), once a task.
Shingler = Callable[[], CharRuns | WordRuns]

#: Items of a block of a bucket or class, and bytes of their texts: blocks are compared two at a time.
BLOCK, BLOCK_BYTES = 1024, 16_000_000
#: Texts whose shingles are made at a time, and pairs of sets up to which each is compared by itself.
TEXTS, FEW = 512, 400
#: Rows of a few numbers up to which a table is broadcast to the texts that it is joined with; a longer one is joined by shuffles.
BROADCAST_ROWS = 2_000_000
#: Shingles of two blocks that are compared at a time.
COLUMNS = 2048
#: Keys that a task deals out at a time, and the parts (a power of two) that it deals them to.
KEYS, PART_BITS = 1 << 20, 12
PARTS = 1 << PART_BITS
DEALT = "part int, low binary, ids binary"
#: Items that are signed at a time, and ids (a power of two) of those signed lately that a task remembers.
SIGNED, LATELY = 500, 1 << 18


def signature_bands(
    items: DataFrame, shingler: Shingler, bands: int, rows: int, extra: int = 0, dealt: bool = False
) -> DataFrame:
    """``id, keys`` of every item (``id`` long, ``text``) with a shingle; with ``extra`` also
    ``sig``: the signature of ``bands * rows + extra`` values as bytes.  With ``dealt`` the keys leave the
    task that makes them in runs (see :func:`buckets_of`): ``part, low, ids``."""
    schema = "id long, keys array<long>" + ", sig binary" * bool(extra)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        of, hashes, lately = shingler(), MinHash(bands * rows + extra), ~np.arange(LATELY)
        for batch in batches:
            batch = batch.filter(batch.column(1).is_valid())
            for at in range(0, batch.num_rows, SIGNED):
                part = batch.slice(at, SIGNED)
                ids, first = np.unique(part.column(0).to_numpy(zero_copy_only=False), return_index=True)
                # A copy that this task has signed lately would only repeat the row.
                new = lately[ids & (LATELY - 1)] != ids
                ids, first = ids[new], first[new]
                lately[ids & (LATELY - 1)] = ids
                if not len(ids):
                    continue
                flat, sizes = of.flat(part.column(1).take(pa.array(first)).to_pylist())
                some = np.flatnonzero(sizes)
                if len(some):
                    signatures = hashes.of_flat(flat, [n for n in sizes if n])
                    yield ids[some], band_keys(signatures, bands, rows), signatures

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys, signatures in signed(batches):
            columns = [pa.array(ids), pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)), pa.array(keys.ravel()))]
            if extra:
                columns.append(pa.array([s.tobytes() for s in signatures], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["id", "keys", "sig"][: len(columns)])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_runs((keys.ravel(), np.repeat(ids, bands)) for ids, keys, _ in signed(batches))

    items = items.select("id", "text")
    return items.mapInArrow(deal, DEALT) if dealt else items.mapInArrow(sign, schema)


def buckets_of(signed: DataFrame) -> DataFrame:
    """``key, id, size`` of the buckets with two or more different items.

    Keys are shuffled in runs: a row has many keys of one of ``PARTS`` parts, and their items' ids.  A part's
    keys are sorted at once, a PARTS-th of all; of a key 44 bits decide (two that agree in them make one bucket,
    whose pairs are checked like others).  ``signed`` has ``id, keys``, or rows that are dealt already.
    """
    rows = signed.select("id", "keys").mapInArrow(_dealt, DEALT) if "keys" in signed.columns else signed
    rows = rows.repartition("part").sortWithinPartitions("part")
    return rows.mapInArrow(_met, "key long, id long, size long")


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys and ids of ``id, keys`` rows, dealt out by the keys' parts."""
    def flat() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            keys = batch.column(1)
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), np.diff(keys.offsets.to_numpy()))
            yield keys.flatten().to_numpy(zero_copy_only=False), ids

    return _in_runs(flat())


def _in_runs(rows: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Keys and their ids, dealt out ``KEYS`` at a time."""
    waiting, n = [], 0
    for keys, ids in rows:
        waiting.append((keys, ids))
        n += len(ids)
        if n >= KEYS:
            yield _by_part(waiting)
            waiting, n = [], 0
    if n:
        yield _by_part(waiting)


def _by_part(waiting: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    keys, ids = (np.concatenate(x) for x in zip(*waiting))
    keys = keys.view(np.uint64)
    part = (keys & np.uint64(PARTS - 1)).astype(np.uint16)
    order = np.argsort(part, kind="stable")
    ends = np.cumsum(np.bincount(part, minlength=PARTS))
    some = np.flatnonzero(np.diff(ends, prepend=0))
    offsets = np.append(0, ends[some])
    columns = [pa.array(some, pa.int32())]
    for values in ((keys >> np.uint64(PART_BITS)).astype(np.uint32)[order], ids[order]):
        at = pa.py_buffer((offsets * values.itemsize).astype(np.int32))
        columns.append(pa.BinaryArray.from_buffers(pa.binary(), len(some), [None, at, pa.py_buffer(values)]))
    return pa.RecordBatch.from_arrays(columns, names=["part", "low", "ids"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The buckets with several items, from the rows of :func:`_dealt` in the parts' order."""
    for (part,), (low, ids) in streamed_groups(batches, 1):
        low, ids = np.frombuffer(b"".join(low), np.uint32), np.frombuffer(b"".join(ids), np.int64)
        order = np.argsort(low)
        low, ids = low[order], ids[order]
        same = low[1:] == low[:-1]
        met = np.flatnonzero(np.append(same, False) | np.append(False, same))
        order = np.lexsort((ids[met], low[met]))
        low, ids = low[met][order], ids[met][order]
        new = np.append(True, low[1:] != low[:-1]) if len(low) else np.zeros(0, bool)
        first = new | np.append(True, ids[1:] != ids[:-1])[: len(new)]  # an item may come from several tasks
        low, ids = low[first], ids[first]
        _, group, sizes = np.unique(low, return_inverse=True, return_counts=True)
        sizes = sizes[group] if len(low) else np.zeros(0, np.int64)
        kept = sizes > 1
        if kept.any():
            keys = (low[kept].astype(np.int64) << PART_BITS) + part
            columns = [pa.array(x) for x in (keys, ids[kept], sizes[kept].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "id", "size"])


def members_of(buckets: DataFrame) -> DataFrame:
    """``key, id, size, rep``: ``rep`` is the bucket's member whose buckets have most members."""
    shares = buckets.groupBy("id").agg(F.sum("size").alias("shares"))
    central = F.max(F.struct("shares", "id")).over(Window.partitionBy("key"))
    return buckets.join(shares, "id").select("key", "id", "size", central["id"].alias("rep"))


def _similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    # Sizes alone rule out most pairs.
    return min(len(a), len(b)) >= least * max(len(a), len(b)) and jaccard(a, b) >= least


def verify(pairs: DataFrame, texts: DataFrame, shingler: Shingler, least: float) -> DataFrame:
    """The pairs (``a``, ``b``) whose whole texts have a Jaccard similarity of ``least`` or more.  Texts are
    joined by id on both sides; a text with many partners is a skewed side that adaptive joins split."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shingler()
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                a, b, text_a, text_b = (c.to_pylist() for c in part.columns)
                texts = dict(zip(b, text_b)) | dict(zip(a, text_a))  # pairs often share a representative
                sets = dict(zip(texts, shingle_sets(of, list(texts.values()))))
                kept = [i for i, (x, y) in enumerate(zip(a, b)) if _similar(sets[x], sets[y], least)]
                yield pa.RecordBatch.from_arrays([part.column(i).take(pa.array(kept, pa.int64())) for i in (0, 1)], names=["a", "b"])

    rows = left.join(small(pairs), "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(check, "a long, b long")


def small(table: DataFrame) -> DataFrame:
    """A written table, marked to be broadcast if it has few rows."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def near_classes(
    items: DataFrame,
    shingler: Shingler,
    least: float,
    bands: int,
    rows: int,
    name: str,
    extra: int = 0,
    prune: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``id, class`` of the items with a link; the class is the smallest id.  And ``id, text`` of
    the items that share a bucket (a table of :func:`shared_table`), for the caller to drop.

    ``items`` has ``id`` (long, the same for equal texts) and ``text``; it may
    repeat.  Items are linked if the Jaccard similarity of their shingles is
    ``least`` or more and they share a bucket.  ``prune(pairs, signed)`` may drop
    pairs by their signatures before texts are fetched.  Items without a shingle
    have no link.
    """
    signed = signature_bands(items, shingler, bands, rows, extra, dealt=not prune)
    if prune:
        signed = shared_table(signed, f"{name}-signed")
    buckets = shared_table(buckets_of(signed), f"{name}-buckets")
    # Only texts that share a bucket with another one are ever fetched again.
    ids = shared_table(buckets.select("id").distinct(), f"{name}-ids")
    texts = items.select("id", "text").join(small(ids), "id", "left_semi").dropDuplicates(["id"])
    texts = shared_table(texts, f"{name}-texts")
    members = shared_table(members_of(buckets), f"{name}-members")
    drop_tables(buckets, ids)
    pairs = members.where("id <> rep").select(F.greatest("id", "rep").alias("a"), F.least("id", "rep").alias("b")).distinct()
    pairs = shared_table(pairs, f"{name}-pairs")
    if prune:
        before, pairs = pairs, shared_table(prune(pairs, signed), f"{name}-pairs")
        drop_tables(before, signed)
    links = shared_table(verify(pairs, texts, shingler, least), f"{name}-links")
    drop_tables(pairs)
    classes = components(links, f"{name}-classes")
    left = shared_table(mixed_members(members, classes), f"{name}-mixed")
    if not left.isEmpty():
        more = shared_table(links_between(left, texts, shingler, least), f"{name}-more")
        if not more.isEmpty():
            classes = components(more.union(classes.toDF("a", "b")), f"{name}-classes")
    drop_tables(members, links, left)
    return classes, texts


def mixed_members(members: DataFrame, classes: DataFrame) -> DataFrame:
    """``key, id, class`` of the buckets' members, without the representatives, where these are of several classes."""
    # A representative has met all others, so a bucket of two is settled.
    rest = members.where("id <> rep and size > 2").select("key", "id").join(classes, "id", "left")
    rest = rest.select("key", "id", F.coalesce("class", "id").alias("class"))
    bucket = Window.partitionBy("key")
    rest = rest.withColumn("low", F.min("class").over(bucket)).withColumn("high", F.max("class").over(bucket))
    return rest.where("low < high").drop("low", "high")


def _blocked(rows: DataFrame, group: str) -> DataFrame:
    """``rows`` (with ``id``, ``text``) of each group, in pairs of blocks ``low <= high``; ``own`` is the row's block.

    A group of n items is copied about n / BLOCK times.
    """
    size = F.greatest(F.count("*") / BLOCK, F.sum(F.octet_length("text")) / BLOCK_BYTES)
    sizes = rows.groupBy(group).agg(F.ceil(size).cast("int").alias("blocks"))
    rows = rows.join(sizes, group).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    return rows.repartition(group, "low", "high").sortWithinPartitions(group, "low", "high")


def _with_sets(groups: Iterator[tuple[list, list]], of) -> Iterator[tuple[list, list]]:
    """The groups, their last column (texts) as sets of shingles; those of small groups are made together."""
    waiting, texts = [], 0
    for key, columns in groups:
        waiting.append((key, columns))
        texts += len(columns[0])
        if texts >= TEXTS:
            yield from _made(waiting, of)
            waiting, texts = [], 0
    yield from _made(waiting, of)


def _made(groups: list[tuple[list, list]], of) -> Iterator[tuple[list, list]]:
    sets = iter(shingle_sets(of, [t for _, columns in groups for t in columns[-1]]))
    for key, columns in groups:
        yield key, [*columns[:-1], list(islice(sets, len(columns[0])))]


def links_between(mixed: DataFrame, texts: DataFrame, shingler: Shingler, least: float) -> DataFrame:
    """``a, b``: links that join the classes of each bucket of ``mixed`` (``key, id, class``) wherever two similar texts are in both.

    Members outside a block's largest class are compared with all; links
    that join what others have joined stay in the task.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, low, high), (own, ids, classes, sets) in _with_sets(streamed_groups(batches, 3), shingler()):
            own, classes = np.array(own), np.array(classes)
            kinds, counts = np.unique(classes, return_counts=True)
            if len(kinds) < 2:
                continue
            few = classes != kinds[counts.argmax()]
            sides = [(few, ~few), (few, few)] if low == high else [
                (few & (own == low), own == high), (~few & (own == low), few & (own == high))
            ]
            found = []
            for x, y in sides:
                x, y = np.flatnonzero(x), np.flatnonzero(y)
                near = jaccard_from(sets, x, y) >= least
                near &= classes[x][:, None] != classes[y][None, :]
                found += [(int(x[i]), int(y[j])) for i, j in zip(*near.nonzero())]
            joined: dict[int, int] = {}

            def root(c: int) -> int:
                while joined.get(c, c) != c:
                    c = joined[c]
                return c

            out = []
            for i, j in found:
                p, q = root(int(classes[i])), root(int(classes[j]))
                if p != q:
                    joined[max(p, q)] = min(p, q)
                    out.append((max(ids[i], ids[j]), min(ids[i], ids[j])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])

    rows = _blocked(texts.join(small(mixed), "id"), "key")
    return rows.select("key", "low", "high", "own", "id", "class", "text").mapInArrow(compare, "a long, b long")


def count_links(classes: DataFrame, texts: DataFrame, shingler: Shingler, least: float) -> DataFrame:
    """``id, n_links``: for each item of ``classes`` the other items of its class whose Jaccard
    similarity with it is ``least`` or more; ``texts`` as :func:`near_classes` returns them.

    Every pair of a class is compared, in tasks of two blocks of the class each;
    only counts leave a task.
    """
    texts = shared_table(texts.join(classes, "id").select("id", "class", "text"), "class-texts")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, low, high), (own, ids, sets) in _with_sets(streamed_groups(batches, 3), shingler()):
            own = np.array(own)
            counts = np.zeros(len(sets), np.int64)
            if low == high:
                every = np.arange(len(sets))
                near = jaccard_from(sets, every, every) >= least
                np.fill_diagonal(near, False)
                counts += near.sum(1)
            else:
                x, y = np.flatnonzero(own == low), np.flatnonzero(own == high)
                near = jaccard_from(sets, x, y) >= least
                counts[x], counts[y] = near.sum(1), near.sum(0)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(counts)], names=["id", "n"])

    rows = _blocked(texts, "class").select("class", "low", "high", "own", "id", "text")
    counts = rows.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n_links"))
    counts = shared_table(counts, "link-counts")
    drop_tables(texts)
    return counts


def jaccard_from(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The Jaccard similarity of each of ``sets[x]`` with each of ``sets[y]``; 0 for two empty ones."""
    if len(x) * len(y) <= FEW:
        return np.array([jaccard(sets[i], sets[j]) for i in x for j in y]).reshape(len(x), len(y))
    n = np.array([len(s) for s in sets])
    both = common_shingles([sets[i] for i in x], [sets[i] for i in y])
    return both / np.maximum(n[x][:, None] + n[y][None, :] - both, 1)


def common_shingles(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each of ``left`` shares with each of ``right`` (distinct shingles each)."""
    both = np.zeros((len(left), len(right)))
    if not left or not right:
        return both
    flat = [np.concatenate(x) for x in (left, right)]
    shared = np.intersect1d(*flat)
    parts = []
    for x, sets in zip(flat, (left, right)):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        column = np.minimum(np.searchsorted(shared, x), max(len(shared) - 1, 0))
        known = shared[column] == x if len(shared) else np.zeros(len(x), bool)
        order = np.argsort(column[known], kind="stable")
        parts.append((row[known][order], column[known][order]))
    for at in range(0, len(shared), COLUMNS):
        dense = []
        for (row, column), sets in zip(parts, (left, right)):
            lo, hi = np.searchsorted(column, (at, at + COLUMNS))
            m = np.zeros((len(sets), min(COLUMNS, len(shared) - at)), np.float32)
            m[row[lo:hi], column[lo:hi] - at] = 1
            dense.append(m)
        both += dense[0] @ dense[1].T
    return both
