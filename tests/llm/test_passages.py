"""Repeated passages: planted at any word, with edits, against brute force; edge cases."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerday.llm import passage_dedup
from ledgerday.llm.passage_dedup import BAND, DROP, cut, cut_passages, extension, extensions, repeated_passages, without_words


def spans_of(rows):
    return {r.doc_id: (r.first_word, r.end_word) for r in rows}


def matching(a, b, least=3):
    """Word places of ``a`` that lie in runs of ``least`` words that stand in ``b`` too, by brute force."""
    runs = {tuple(b[i : i + least]) for i in range(len(b) - least + 1)}
    return {i + k for i in range(len(a) - least + 1) if tuple(a[i : i + least]) in runs for k in range(least)}


def test_paragraphs_are_the_same_in_every_copy(prose):
    passage = prose(200, 1)
    texts = [prose(n, 10 + n) + " " + passage + "\n" + prose(50, 20 + n) for n in (3, 40, 77)] + ["", " \n", "One two", "a " * 200, "x"]
    joined, first, own, low, high = cut([t.encode() for t in texts])
    inner = [{a - n for a, o in zip(low.tolist(), own.tolist()) if o == k and n + 5 <= a < n + 195} for k, n in enumerate((3, 40, 77))]
    assert inner[0] == inner[1] == inner[2] and len(inner[0]) > 10
    for k, text in enumerate(texts):
        spans = [(a, b) for a, b, o in zip(low.tolist(), high.tolist(), own.tolist()) if o == k]
        words = text.lower().split()
        assert [i for a, b in spans for i in range(a, b)] == list(range(len(words))) and all(0 < b - a <= 64 for a, b in spans)
        parts = [joined[a:b].decode().split() for a, b, o in zip(first.tolist(), [*first[1:].tolist(), len(joined)], own.tolist()) if o == k]
        assert [w for p in parts for w in p] == words and [len(p) for p in parts] == [b - a for a, b in spans]
        alone = cut([text.encode()])
        assert alone[3].tolist() == [a for a, _ in spans]
    assert len(cut([])[1]) == len(cut([b""])[1]) == 0


def test_extension_aligns_beginnings():
    assert extension("a b c d".split(), "a b c x".split()) == 3 and extension([], ["a"]) == 0 == extension(["a"], [])
    assert extension("a b x d e f".split(), "a b y d e f".split()) == 6  # over an edited word
    assert extension("x a b".split(), "y c d".split()) == 0


def plain_extension(own, other):
    """One pair, cell by cell."""
    best = length = 0
    score = {(0, j): -j for j in range(min(len(other), BAND) + 1)}
    for i, word in enumerate(own, 1):
        for j in range(max(0, i - BAND), min(len(other), i + BAND) + 1):
            ways = [score[c] - 1 for c in ((i - 1, j), (i, j - 1)) if c in score]
            if j and (i - 1, j - 1) in score:
                ways.append(score[i - 1, j - 1] + (1 if word == other[j - 1] else -1))
            score[i, j] = max(ways)
        top = max((v for (r, _), v in score.items() if r == i), default=None)
        if top is None or top < best - DROP:
            break
        if top > best:
            best, length = top, i
    return length


def test_alignments_of_many_pairs_at_once_equal_the_plain_one():
    r = random.Random(4)
    pairs = [([], []), (["a"] * 30, ["a"] * 5), (["a"] * 5, ["a"] * 30), (["b"] * 30, ["a"])]
    for _ in range(400):
        own = [r.choice("abcdefgh") for _ in range(r.randint(0, 60))]
        other = [w for w in own if r.random() > 0.1]
        for _ in range(r.randint(0, 12)):
            other.insert(r.randint(0, len(other)), r.choice("abcxyz"))
        pairs.append((own, other[: r.randint(0, 70)]))
    got = extensions([a for a, _ in pairs], [b for _, b in pairs]).tolist()
    assert got == [plain_extension(a, b) for a, b in pairs] and len(set(got)) > 30
    assert extensions([], []).tolist() == []


def test_paragraphs_are_gone_before_ends_are_aligned(docs_of, prose, monkeypatch):
    """Disk: the table of all paragraphs' texts doesn't stay while the runs' ends are shuffled."""
    left, real = {}, passage_dedup.shared_table

    def watched(df, name):
        out = real(df, name)
        folder = os.path.dirname(out.scratch_path.removeprefix("file:"))
        tables.append(os.path.basename(out.scratch_path))
        left[name] = [t[: t.rindex("-")] for t in tables if os.path.exists(f"{folder}/{t}")]
        return out

    tables = []
    monkeypatch.setattr(passage_dedup, "shared_table", watched)
    passage = prose(80, 50)
    texts = [prose(30, 1) + " " + passage, prose(50, 2) + " " + passage + " " + prose(20, 3)]
    assert spans_of(repeated_passages(docs_of([*texts, texts[1]])).collect()) == {0: (30, 110), 1: (0, 150), 2: (0, 150)}
    assert left["passage-ends"] == left["passages"][:-1] == ["passage-runs", "passage-ends"]


def test_passages_pasted_at_any_word_are_found(docs_of, prose):
    passage = prose(70, 50, stop=10)
    texts = [prose(45, 1) + " mid " + passage + " and " + prose(60, 2), prose(91, 3) + " in " + passage.upper().lower() + " so " + prose(30, 4),
             prose(300, 6), prose(20, 7) + "\n" + prose(10, 60), prose(33, 8) + "\n" + prose(10, 60), None, "", prose(15000, 9)]
    docs = docs_of(texts).withColumn("removed", F.lit("clash")).withColumn("place", F.lit(1)).withColumn("unit", F.lit("u"))
    rows = repeated_passages(docs).collect()
    assert spans_of(rows) == {0: (46, 116), 1: (92, 162)} and len(rows) == 2
    by = {r.doc_id: r for r in rows}
    assert by[0].removed == [] and by[0].n_words == 70 and [tuple(x) for x in by[1].removed] == [(92, 162)]
    cut = {r.doc_id: r.text for r in cut_passages(docs).collect()}
    assert cut[0] == texts[0] and cut[5] is None and cut[6] == "" and cut[1] == prose(91, 3) + " in so " + prose(30, 4)
    assert cut_passages(docs).columns == docs.columns
    assert repeated_passages(docs.limit(0)).count() == 0


def test_copies_near_copies_and_repeats_within_a_text(docs_of, prose):
    a = prose(120, 21, stop=40)
    ws = a.split()
    ws[60] = "other"
    twice = prose(40, 23) + " " + prose(30, 24) + " " + prose(30, 25) + " " + prose(40, 23)
    rows = repeated_passages(docs_of([a, a, " ".join(ws), prose(100, 22), (None, a), twice])).collect()
    by = {r.doc_id: r for r in rows if r.doc_id != 5}
    assert set(by) == {0, 1, 2, None} and all((r.first_word, r.end_word) == (0, 120) for r in by.values())
    assert by[None].removed == [] and [tuple(x) for x in by[0].removed] == [tuple(x) for x in by[2].removed] == [(0, 120)]
    own = sorted((r.first_word, r.end_word, len(r.removed)) for r in rows if r.doc_id == 5)
    assert own == [(0, 40, 0), (100, 140, 1)]


@pytest.mark.parametrize("every", [None, 10])
def test_recall_of_passages_with_an_edited_word_in_every_sentence(docs_of, prose, every):
    """120 passages of 50 to 120 words, each in two texts at any word; the second copy has an edited word in every ten."""
    r = random.Random(9)
    texts, pairs = [], []
    for i in range(120):
        passage = prose(r.randint(50, 120), 100 + i, stop=10).split()
        copy = list(passage)
        for at in range(r.randint(0, 9), len(copy), every or len(copy) + 10):
            copy[at] = f"edit{i}x{at}"
        for n, words in enumerate((passage, copy)):
            texts.append(prose(r.randint(5, 60), 3000 + 2 * i + n) + " " + " ".join(words) + " " + prose(r.randint(5, 60), 6000 + 2 * i + n))
        pairs.append((2 * i, 2 * i + 1))
    texts += [prose(300, 9000 + i) for i in range(40)]
    rows = repeated_passages(docs_of(texts)).collect()
    covered = {}
    for row in rows:
        covered.setdefault(row.doc_id, set()).update(range(row.first_word, row.end_word))
    assert not {d for d in covered if d >= 240}  # clean texts are left alone
    found = sum(a in covered and b in covered for a, b in pairs)
    assert found >= (0.95 if every else 1) * len(pairs)
    wanted = got = 0
    for a, b in pairs:
        for x, y in ((a, b), (b, a)):
            shared = matching(texts[x].lower().split(), texts[y].lower().split())
            wanted += len(shared)
            got += len(shared & covered.get(x, set()))
            assert len(covered.get(x, set()) - shared) <= 0.25 * len(shared) + 8
    print(found, got / wanted)
    assert got >= (0.9 if every else 0.99) * wanted


def test_cutting_keeps_the_rest(prose):
    assert without_words("  a b\n c d ", [(1, 2)]) == "  a c d " and without_words("a b", [(0, 2)]) == "" and without_words("a b c", []) == "a b c"
    assert without_words("a b c d e", [(3, 4), (0, 1)]) == "b c e"


def test_edge_texts(docs_of, prose):
    same = "word " * 500
    texts = [same, same, "!!! ... " * 40, "!!! ... " * 40, "one two", "one two", "\n\t ", "日本 語 " * 60, "x" * 100_000 + " " + prose(60, 1), prose(60, 1)]
    rows = repeated_passages(docs_of(texts)).collect()
    assert {0, 1, 7, 8, 9} <= {r.doc_id for r in rows} <= {0, 1, 2, 3, 7, 8, 9} and len(cut_passages(docs_of(texts)).collect()) == len(texts)
    assert spans_of([r for r in rows if r.doc_id in (8, 9)]) == {8: (1, 61), 9: (0, 60)}


def plain_removed(parts, left, right):
    """One run, paragraph by paragraph."""
    spans, joined = [], False
    for i, (low, high, kept) in enumerate(parts):
        if not kept:
            start = high - left if i == 0 else low
            end = low + right if i == len(parts) - 1 else high
            if joined:
                spans[-1][1] = end
            else:
                spans.append([start, end])
        joined = not kept
    return [{"from": a, "end": b} for a, b in spans]


def test_removed_spans_of_many_runs_at_once():
    r = random.Random(3)
    runs = [[(10 * i, 10 * i + r.randint(5, 10), r.random() < 0.5) for i in range(n)] for n in [1, 1, 2, 2, 3, 7] * 50]
    left, right = ([r.randint(1, 20) for _ in runs] for _ in range(2))
    kind = pa.list_(pa.struct([("from_word", pa.int64()), ("end_word", pa.int64()), ("kept", pa.bool_())]))
    parts = pa.array([[dict(zip(("from_word", "end_word", "kept"), p)) for p in run] for run in runs], kind)
    want = [plain_removed(*x) for x in zip(runs, left, right)]
    assert passage_dedup.removed_spans(parts, np.array(left), np.array(right)).to_pylist() == want
    # Part of a longer array, and none at all.
    assert passage_dedup.removed_spans(parts.slice(100, 50), np.array(left[100:150]), np.array(right[100:150])).to_pylist() == want[100:150]
    assert passage_dedup.removed_spans(parts.slice(0, 0), np.empty(0, np.int64), np.empty(0, np.int64)).to_pylist() == []


def test_paragraphs_have_no_blanks_around(spark, docs_of, prose):
    rows = passage_dedup.paragraphs_of(docs_of([f" \n\t{prose(60, 5)} \r\n ", "Ab\u00a0 cD é\n"])).collect()
    assert len(rows) > 3 and all(x.text and x.text == x.text.strip(" \t\r\n") for x in rows)
    assert [x.text for x in rows if x.doc_id == 1] == ["ab\u00a0 cd é"]
