"""Spelling variants: the vocabulary's minimised acceptor, composed with a one-edit
transducer and the acceptor again.

The composition's states are (state of the left word, state of the right word,
edit taken or not); before the edit both words are in one state.  Two words
that differ by one edit share the first half of the shorter word's letters or
its other half, so the vocabulary is dealt into partitions by a shared half.
A partition of a shared first half is what the composition reaches from one
initial state, that behind the half; one of a shared second half ends in it.
Each partition builds the minimised acceptor of the letters that aren't shared
and enumerates the accepted pairs there.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerday.llm.common import shared_table

#: Code points of a word, and its occurrences, at least.
MIN_LENGTH, MIN_COUNT = 5, 3
#: A run is misspelled on purpose where this divides the checksum of its document and itself.
DAMAGED = 97
#: How many times as often a word's form occurs, at least.
RATIO = 2
#: Words of a partition from which it is dealt anew, by halves of what its words don't share.
MAX_GROUP = 20_000
#: Different words that a counting task holds.
HELD_WORDS = 300_000

# Latin-1: A-Z lowered, a-z and every letter place from 0xC0 on kept, anything else a blank.
_RUN_BYTES = bytes(
    c + 32 if "A" <= chr(c) <= "Z" else c if "a" <= chr(c) <= "z" or c >= 0xC0 else 32 for c in range(256)
)


class Acceptor:
    """The minimal deterministic acceptor of sorted, different words."""

    def __init__(self, words: list[str]):
        self.edges: list[dict[str, int]] = []
        self.final: list[bool] = []
        #: Lengths of the words that each state accepts.
        self.lengths: list[frozenset[int]] = []
        known: dict[tuple, int] = {}
        open_states: list[tuple[list[bool], list[tuple[str, int]]]] = [([False], [])]
        letters: list[str] = []

        def close(depth: int) -> None:
            while len(letters) > depth:
                (final,), edges = open_states.pop()
                open_states[-1][1].append((letters.pop(), self._state(final, edges, known)))

        for word in words:
            shared = 0
            while shared < len(letters) and shared < len(word) and letters[shared] == word[shared]:
                shared += 1
            close(shared)
            for letter in word[shared:]:
                letters.append(letter)
                open_states.append(([False], []))
            open_states[-1][0][0] = True
        close(0)
        (final,), edges = open_states[0]
        self.start = self._state(final, edges, known)

    def _state(self, final: bool, edges: list[tuple[str, int]], known: dict[tuple, int]) -> int:
        key = (final, tuple(edges))
        if key not in known:
            known[key] = len(self.edges)
            self.edges.append(dict(edges))
            self.final.append(final)
            lengths = {n + 1 for _, to in edges for n in self.lengths[to]}
            self.lengths.append(frozenset(lengths | {0} if final else lengths))
        return known[key]

    def _both(self, p: int, q: int, length: int, but: str = "") -> Iterator[str]:
        """The words of ``length`` letters that both states accept and that don't begin with ``but``."""
        todo = [(p, q, length, "")]
        while todo:
            p, q, left, word = todo.pop()
            if not left:
                if self.final[p] and self.final[q]:
                    yield word
                continue
            others = self.edges[q]
            for letter, to in self.edges[p].items():
                other = others.get(letter)
                if other is None or (letter == but and not word):
                    continue
                if left - 1 in self.lengths[to] and left - 1 in self.lengths[other]:
                    todo.append((to, other, left - 1, word + letter))

    def one_edit_pairs(self, length: int) -> Iterator[tuple[str, str]]:
        """The accepted pairs (x, y) of the composition with one edit between: ``x`` has
        ``length`` letters, ``y`` as many (one replaced; x < y there) or one more.

        Each pair has one path: a letter is inserted behind its equals.
        """
        todo = [(self.start, "")]
        while todo:
            p, before = todo.pop()
            left = length - len(before)
            if left < 0:
                continue
            edges = sorted(self.edges[p].items())
            for i, (x, to_x) in enumerate(edges):
                if left and left - 1 in self.lengths[to_x]:
                    for y, to_y in edges[i + 1 :]:
                        if left - 1 in self.lengths[to_y]:
                            for rest in self._both(to_x, to_y, left - 1):
                                yield before + x + rest, before + y + rest
                if left in self.lengths[p] and left in self.lengths[to_x]:
                    for rest in self._both(p, to_x, left, but=x):
                        yield before + rest, before + x + rest
                todo.append((to_x, before + x))


def near_in_group(words: dict[str, int], shortest: int, steps: list[tuple[int, int]], low: int, length: int):
    """``(x, y)`` of the near words of a partition of words that share all but ``length`` letters
    from place ``low`` on (one more in the longer words), the shorter of which has ``shortest``.

    ``steps`` has, for each time that a second half was shared, the place and
    size of the first half: pairs that share that one too are met there.
    """
    behind = shortest - low - length
    whole = {w[low : len(w) - behind]: w for w in words}
    for x, y in Acceptor(sorted(whole)).one_edit_pairs(length):
        x, y = whole[x], whole[y]
        if not any(x[at : at + n] == y[at : at + n] for at, n in steps):
            yield x, y


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damaged: int = DAMAGED) -> DataFrame:
    """``word, n``: the words of whole texts and how often they occur.

    Words are maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` with A-Z lowered; a run of a
    document whose crc32 of ``<id>:<run>`` is divisible by ``damaged`` loses one
    letter.  Tasks pass on counts, not words.  A null id counts as an empty one.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def batch() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            out = pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for rows in batches:
            for doc, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                seed = zlib.crc32(f"{doc}:".encode())
                # Runs are Latin-1 letters, so a text is cut as bytes, a byte a code point.
                for run, n in Counter((text or "").encode("latin-1", "replace").translate(_RUN_BYTES).split()).items():
                    size = len(run)
                    if size < MIN_LENGTH:
                        continue
                    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
                    if not h % damaged:
                        if size == MIN_LENGTH:
                            continue
                        run = run[: h % size] + run[h % size + 1 :]
                    held[run] += n
                if len(held) > HELD_WORDS:
                    yield batch()
        yield batch()

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def partitions_of(words: DataFrame, max_group: int = MAX_GROUP) -> DataFrame:
    """``shortest, steps, shared, low, length, word, n``: the words in each partition where they may have a near one.

    A word is in four: with those of its length and one more, and with those of
    its length and one less, by either half.  Partitions of over ``max_group``
    words are dealt anew by halves of the letters that aren't shared, until one letter is left.
    """
    shortest = F.explode(F.filter(F.array(F.char_length("word"), F.char_length("word") - 1), lambda m: m >= MIN_LENGTH))
    rows = words.select(
        "word", "n", shortest.alias("shortest"), F.lit("").alias("steps"), F.lit("").alias("shared"), F.lit(0).alias("low")
    ).withColumn("length", F.col("shortest"))
    done, rows = None, _halved(rows)
    key = ["shortest", "steps", "shared"]
    while True:
        hot = rows.where("length > 1").groupBy(*key).agg(F.count("*").alias("size")).where(F.col("size") > max_group)
        hot = shared_table(hot.select(*key), "hot-partitions")
        if hot.isEmpty():
            return rows if done is None else done.unionByName(rows)
        cool = rows.join(hot, key, "left_anti").select(rows.columns)
        done = cool if done is None else done.unionByName(cool)
        rows = _halved(rows.join(hot, key, "left_semi"))


def _halved(rows: DataFrame) -> DataFrame:
    half = F.floor(F.col("length") / 2).cast("int")
    behind = F.col("shortest") - F.col("low") - F.col("length")
    end = F.char_length("word") - behind  # after what isn't shared
    first = F.struct(
        F.concat_ws(" ", "steps", F.concat(F.lit("f"), half)).alias("steps"),
        F.concat("shared", F.lit(" "), F.substring("word", F.col("low") + 1, half)).alias("shared"),
        (F.col("low") + half).alias("low"), (F.col("length") - half).alias("length"),
    )
    rest = F.col("length") - half
    second = F.struct(
        F.concat_ws(" ", "steps", F.concat(F.lit("s"), F.col("low"), F.lit("."), half)).alias("steps"),
        F.concat("shared", F.lit(" "), F.substring("word", end - rest + 1, rest)).alias("shared"),
        F.col("low").alias("low"), half.alias("length"),
    )
    return rows.select("word", "n", "shortest", F.explode(F.array(first, second)).alias("p")).select(
        "shortest", "p.steps", "p.shared", "p.low", "p.length", "word", "n"
    )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, dict[str, int]]]:
    """The partitions in rows sorted by partition: ``(shortest, steps, shared, low, length)`` and its words."""
    last, words = None, {}
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(7)]
        for *key, word, n in zip(*columns):
            if key != last:
                if len(words) > 1:
                    yield last, words
                last, words = key, {}
            words[word] = n
    if len(words) > 1:
        yield last, words


def _compose(dealt: DataFrame, found, schema: str) -> DataFrame:
    """``found(words, pairs)`` of every partition as rows; partitions stream by, one in memory at a time."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (shortest, steps, _, low, length), words in _groups(batches):
            seconds = [tuple(map(int, s[1:].split("."))) for s in steps.split() if s[0] == "s"]
            out += found(words, near_in_group(words, shortest, seconds, low, length))
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)

    key = ["shortest", "steps", "shared"]
    rows = dealt.select("shortest", "steps", "shared", "low", "length", "word", "n")
    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, schema)


def near_pairs(words: DataFrame, max_group: int = MAX_GROUP) -> DataFrame:
    """``x, y`` of the words (``word, n``; different ones) that are one inserted, deleted or replaced letter apart, each pair once."""
    return _compose(partitions_of(words, max_group), lambda _, pairs: list(pairs), "x string, y string")


def _near_statistics(words: dict[str, int], pairs: Iterator[tuple[str, str]]) -> list[tuple]:
    count: Counter = Counter()
    best: dict[str, tuple[int, str]] = {}
    for pair in pairs:
        for word, other in (pair, pair[::-1]):
            count[word] += 1
            rank = (-words[other], other)
            if word not in best or rank < best[word]:
                best[word] = rank
    return [(w, c, -best[w][0], best[w][1]) for w, c in count.items()]


def word_forms(words: DataFrame, max_group: int = MAX_GROUP) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word (``word, n``; different ones).

    ``n_near`` counts the words one edit apart; ``form`` is that of the largest
    n (ties: the smallest word) if its n is ``RATIO`` times the word's or more.
    ``root`` follows the forms to the last.  Partitions pass on a count and the best
    form of each word, not its pairs.  No words: no rows.
    """
    words = words.select("word", "n")
    near = _compose(partitions_of(words, max_group), _near_statistics, "word string, n_near long, best_n long, best string")
    rank = F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))
    near = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(rank).alias("best"))
    enough = -F.col("best.n") >= F.lit(RATIO) * F.col("n")
    forms = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.word")).alias("form"), F.when(enough, -F.col("best.n")).alias("form_n"),
    )
    forms = shared_table(forms, "word-forms")
    # Forms of forms: each round doubles the steps, and n at least doubles a step, so rounds are few.
    ahead = forms.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = ahead.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        stepped = shared_table(stepped, "word-roots")
        ahead = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            break
    return forms.join(ahead, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`word_forms` of the words of whole texts that occur ``MIN_COUNT`` times or more.

    Null and empty texts have no words; a null id counts as an empty one;
    repeated rows each count.  Texts and words may be of any length.  Empty
    table: no rows.  Other columns are ignored.
    """
    words = shared_table(word_counts(docs, id_col, text_col).where(F.col("n") >= MIN_COUNT), "vocabulary")
    return word_forms(words)
