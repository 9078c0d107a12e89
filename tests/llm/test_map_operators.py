"""Operators that work document by document: brute force, exact round trips, edge cases."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerday.llm import decontamination as dc
from ledgerday.llm.classifier import Settings, SubwordClassifier, classify, features, fit_quality, word_features
from ledgerday.llm.licenses import LicenseScanner, TemplateAutomaton, TemplateError, license_scan
from ledgerday.llm.packing import TURN_LIMITS, Limits, Packer, Piece, answers, pack_documents
from ledgerday.llm.token_counts import PieceAutomaton, token_counts
from ledgerday.llm.queries import QUERIES
from ledgerday.llm.vocabulary import byte_level_vocabulary, encoder

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def greedy(pieces, word, continuation=b""):
    n = at = 0
    while at < len(word):
        for end in range(len(word), at, -1):
            if (continuation if at else b"") + word[at:end] in pieces:
                break
        else:
            return None
        n, at = n + 1, end
    return n


@pytest.mark.parametrize("continuation", [b"", b"##"])
def test_piece_counts_equal_greedy_longest_match(continuation):
    r = random.Random(3)
    for _ in range(60):
        def some(k):
            return {bytes(r.choices(b"abc", k=r.randint(1, 5))) for _ in range(k)}
        pieces = some(8) | {continuation + p for p in some(8)}
        a = PieceAutomaton(pieces, continuation=continuation)
        for _ in range(80):
            word = bytes(r.choices(b"abcd" if r.random() < 0.1 else b"abc", k=r.randint(0, 12)))
            assert a.count(word) == greedy(pieces, word, continuation), (pieces, word)


def test_token_counts_of_documents(spark, docs_of):
    pieces, _ = byte_level_vocabulary(VOCABULARY)
    automaton = PieceAutomaton(pieces, marker=b" ")
    texts = ["the unbelievable  thing\n\té", "", None, " \n", "x" * 5000, "the the"]
    rows = token_counts(docs_of(texts).withColumn("n_words", F.lit("clash")), automaton).orderBy("doc_id").collect()
    for text, row in zip(texts, rows):
        ws = (text or "").encode().split()
        assert (row.n_words, row.n_pieces, row.n_unknown) == (len(ws), sum(greedy(pieces, b" " + w) for w in ws), 0)
    assert token_counts(docs_of([]), automaton).count() == 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    want = {r.doc_id: sum(greedy(pieces, b" " + w) for w in r.text.encode().split()) for r in docs.collect()}
    assert {r.doc_id: r.n_pieces for r in token_counts(docs, automaton).collect()} == want
    unknown = token_counts(docs_of(["ab ba cc"]), PieceAutomaton([b"a", b"b"])).first()
    assert (unknown.n_pieces, unknown.n_unknown) == (5, 1)


def test_templates():
    t = TemplateAutomaton("t", 'a <<optional>>b <<optional>>c<<end>><<end>> d <<var words="1-2" match="[0-9]+">> e')
    def ends(s):
        return t.at(s.encode().split(), 0)[0]
    assert ends("a d 1 e") == 4 and ends("a b d 1 2 e x") == 6 and ends("a b c d 1 e") == 6
    assert ends("a c d 1 e") == ends("a d e") == ends("a d 1 2 3 e") == ends("a d x e") == -1
    assert t.n_mandatory == 4 and t.at([b"a", b"d", b"x"], 0)[1] == pytest.approx(2 / 4)
    for bad in ("<<optional>>a", "<<end>>", "<<what>>", "<<optional>>a<<end>>", '<<var words="1-2">> a'):
        with pytest.raises(TemplateError):
            TemplateAutomaton("bad", bad)


def test_license_scan_base_columns_equal_sql(spark, docs_of):
    import duckdb

    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    rows = license_scan(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    for row in rows:
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[row.doc_id]))
        at = [(i, label) for p, label in phrases.items() for i in range(len(ws)) if ws[i : i + len(p.split())] == p.split()]
        assert row.n_words == len(ws) and row.n_base == len(at) and 0 <= row.score <= 1
        assert row.first_word == min((i for i, _ in at), default=None)
        assert row.last_word == max((i for i, _ in at), default=None)
        assert row.base_labels == ",".join(sorted({label for _, label in at}))
        assert set(row.labels.split(",")) >= set(row.base_labels.split(",")) - {""}
    found = Counter(label for r in rows for label in r.labels.split(","))
    assert found["gpl-notice"] == found["gpl"] and found["mit-notice"] == found["mit"]


def test_license_scan_edges(docs_of):
    texts = [None, "", "MIT License", "Licensed under CC BY-NC 4.0.", "It is licensed under the Apache License, Version 2.0!",
             "licensed under the Apache licence", "x " * 20000 + "Released under the MIT License.", "gpl " * 3]
    rows = license_scan(docs_of(texts).withColumn("labels", F.lit(1))).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_base, r.labels, r.score) for r in rows[:3]] == [(0, 0, "", 0.0), (0, 0, "", 0.0), (2, 1, "mit", 0.5)]
    assert [r.labels for r in rows[3:]] == ["cc-by,cc-notice", "apache,apache-2.0-notice", "", "mit,mit-notice", ""]
    assert rows[6].first_word == 20003 and rows[6].score == 1.0 and 0 < rows[5].score < 1
    assert license_scan(docs_of([])).count() == 0
    assert LicenseScanner().scan("this program is free software: you can redistribute it and/or modify it under the terms "
                                 "of the GNU General Public License as published by the Free Software Foundation, either version 3 "
                                 "of the License, or (at your option) any later version")["places"][0][0] == "gpl-header"


def sequences_of(rows):
    out = {}
    for r in rows:
        out.setdefault(r["sequence_id"], []).append(r)
    return [sorted(v, key=lambda r: r["offset"]) for v in out.values()]


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3, "doc_id")
    rows = pack_documents(docs, VOCABULARY).collect()
    want = {r.doc_id: t.encode(r.text, add_special_tokens=False).ids + [0] for r in docs.collect()}
    got = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert r["start"] == len(got.get(r["doc_id"], [])) and r["length"] == len(ids) and r["ids_crc32"] == zlib.crc32(r["ids"])
        assert r["doc_tokens"] == len(want[r["doc_id"]])
        got.setdefault(r["doc_id"], []).extend(ids)
    assert got == want
    for s in sequences_of(rows):
        ends = np.cumsum([r["length"] for r in s])
        assert [r["offset"] for r in s] == [0, *ends[:-1]] and [r["segment"] for r in s] == list(range(len(s)))
        assert ends[-1] == 1024 or ends[-1].bit_count() == 1 and ends[-1] < 1024 and len(s) <= 64


def test_packing_edges(docs_of):
    texts = [None, "", "a<|endoftext|>b", "word " * 3000, "", "tie", "tie"]
    rows = pack_documents(docs_of(texts).coalesce(1).withColumn("start", F.lit("clash")), VOCABULARY).collect()
    whole = {}
    for r in rows:
        whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + r["length"]
    assert whole[0] == whole[1] == whole[4] == 1 and whole[2] == 4 and whole[5] == whole[6] == 2
    assert pack_documents(docs_of([]), VOCABULARY).count() == 0
    assert len(pack_documents(docs_of([(None, "x"), (None, "x")]), VOCABULARY).collect()) == 2


def first_fit(examples, limits):
    """Whole examples, or parts of the long ones, into the first sequence with room: sequences and padding."""
    open_sequences = []
    for loss in examples:
        while len(loss):
            n = min(len(loss), limits.tokens)
            if loss[:n].sum() > limits.loss:
                n = int(np.searchsorted(np.cumsum(loss), limits.loss, side="right"))
            need, loss = (n, 1, int(loss[:n].sum())), loss[n:]
            for room in open_sequences:
                if all(a <= b for a, b in zip(need, room)):
                    room[:] = [b - a for a, b in zip(need, room)]
                    break
            else:
                open_sequences.append([b - a for a, b in zip(need, (limits.tokens, limits.segments, limits.loss))])
    return len(open_sequences), sum(r[0] for r in open_sequences)


def plain_choice(pool, left, limits):
    """The largest dot product of a piece that fits, by all pieces' demands made anew."""
    scale = np.array([limits.tokens, limits.segments, limits.loss], float)
    demand = np.array([(len(p.ids), 1, p.n_loss) for p in pool], float)
    fits = (demand <= left).all(1) & ((left[1] > 1) | (demand[:, 0] == left[0]))
    return int(np.argmax(np.where(fits, demand / scale @ (left / scale), -1))) if fits.any() else None


@pytest.mark.parametrize("limits", [Limits(), Limits(loss=700), Limits(tokens=64, segments=3, loss=40)])
def test_waiting_pieces_keep_their_demands_and_whole_examples_are_one_piece(limits, monkeypatch):
    made, real = [], Piece.__post_init__
    monkeypatch.setattr(Piece, "__post_init__", lambda self: (made.append(self), real(self))[1])
    r, packer, out, whole = np.random.default_rng(5), Packer(limits, waiting=20), [], 0
    for key in range(400):
        loss = r.random(int(r.integers(1, limits.tokens * 2 if key % 9 == 0 else limits.tokens // 4))) < r.random()
        loss[-1] = False
        before = len(made)
        for sequence in packer.add(key, np.full(len(loss), key, np.uint32), loss):
            out.append(sequence)
            n = len(packer.pool)
            assert packer.demand[:n].tolist() == [[len(p.ids), 1, p.n_loss] for p in packer.pool]
            assert packer.held == sum(len(p.ids) for p in packer.pool) and packer.free == sum(int((~p.loss).sum()) for p in packer.pool)
        if len(loss) <= limits.tokens and loss.sum() <= limits.loss and packer.pool and packer.pool[-1].key == key:
            whole += 1
            assert len(made) == before + 1 or len(out) and len(made) > before
    pool = list(packer.pool)
    first = plain_choice(pool, np.array([packer._size(), limits.segments, limits.loss], float), limits)
    out += packer.finish()
    assert whole > 100 and len(made) < 3 * 400
    assert any(first is None or pool[first] is p for s in out for p in s[:1])
    got = {}
    for s in out:
        assert sum(len(p.ids) for p in s) <= limits.tokens and len(s) <= limits.segments and sum(p.n_loss for p in s) <= limits.loss
        for p in s:
            assert p.n_loss == p.loss.sum()
            got[p.key] = got.get(p.key, 0) + len(p.ids)
            assert p.of >= p.start + len(p.ids)
    assert len(got) == 400 and sum(got.values()) == sum(p.of for s in out for p in s if p.start == 0)


def test_the_query_closes_sequences_by_loss_and_pads_less_than_first_fit(spark):
    rows = QUERIES["op3_packing"](spark, SF).collect()
    sequences = sequences_of(rows)
    loss = [sum(r["n_loss"] for r in s) for s in sequences]
    tokens = [sum(r["length"] for r in s) for s in sequences]
    assert max(loss) == TURN_LIMITS.loss and sum(n == TURN_LIMITS.loss for n in loss) >= 5 and max(tokens) == 1024
    padding = sum(1024 - n for n in tokens if n.bit_count() > 1)
    encode, examples = encoder(VOCABULARY), []
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        _, starts = encode(r.text)
        examples.append(np.append(answers(r.text, starts), False))
    assert sum(loss) == sum(int(e.sum()) for e in examples) and sum(tokens) == sum(map(len, examples))
    plain_sequences, plain_padding = first_fit(examples, TURN_LIMITS)
    assert len(sequences) <= plain_sequences and padding <= plain_padding and padding < 0.005 * sum(tokens)


def test_answers_are_every_other_line_from_the_last():
    encode = encoder(VOCABULARY)
    for text in ("ask\nanswer", "system é\nask 日本\n\nanswer 😀 a<|endoftext|>b\n\n", "one line", "\n", "a\nb\nc\r\n"):
        ids, starts = encode(text)
        data, lines = text.encode(), len(text.rstrip().encode().split(b"\n"))
        want = [(lines - 1 - data[:at].count(b"\n")) % 2 == 0 for at in starts]
        got = answers(text, starts).tolist()
        inside = [at < len(text.rstrip().encode()) for at in starts]
        assert [g for g, i in zip(got, inside) if i] == [w for w, i in zip(want, inside) if i] and len(starts) == len(ids)
    text = "naïve 日本 text\nof two lines"
    words = encoder(public_tokenizers.path("word_bpe_49k.json"))
    ids, starts = words(text)
    assert len(ids) == len(starts) and [text.encode()[at : at + 2] for at in starts][0] == b"na" and starts.tolist() == sorted(starts.tolist())


@pytest.mark.parametrize("limits", [Limits(16, 3, 16), Limits(16, 16, 5), Limits(32, 2, 9)])
def test_packer_keeps_every_limit_and_token(limits):
    r = random.Random(5)
    packer, out, want = Packer(limits, waiting=4), [], {}
    for key in range(200):
        n = r.choice([1, 2, 3, 7, 20, 90])
        want[key] = [(key, i) for i in range(n)]
        out += packer.add(key, np.arange(n, dtype=np.uint32), np.array([r.random() < 0.4 for _ in range(n)]))
    out += packer.finish()
    got = {}
    for sequence in out:
        assert sequence and sum(len(p.ids) for p in sequence) <= limits.tokens
        assert len(sequence) <= limits.segments and sum(p.n_loss for p in sequence) <= limits.loss
        for p in sequence:
            got.setdefault(p.key, []).extend((p.key, int(i)) for i in p.ids)
    assert {k: sorted(v) for k, v in got.items()} == want


def test_classifier_learns_held_out_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = fit_quality(docs, labels)
    rows = classify(docs, model).join(labels, "doc_id").where("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert len(good) > 40 and len(bad) > 5
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.97
    # Both kinds of error at the threshold.
    assert sum(s < 0.3 for s in good) <= 1 and sum(s >= 0.3 for s in bad) <= 1
    again = classify(docs, fit_quality(docs.repartition(5), labels)).select("score").orderBy("score").first()
    assert again.score == pytest.approx(min(r.score for r in classify(docs, model).collect()), abs=1e-9)


def test_classifier_edges(spark, docs_of):
    docs = docs_of([(1, "good words here"), (2, "BAD!! BAD!!"), (3, None), (4, ""), (None, "x"), (1, "good words here")])
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 0), (2, None, 1), (None, 1, 1), (4, 7, 0)], "doc_id long, quality int, toxic int")
    model = fit_quality(docs, labels)
    rows = classify(docs.withColumn("score", F.lit("clash")), model).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    assert classify(docs_of([]), model).count() == 0
    assert [r.held_out for r in classify(docs_of(["a"] * 30), model).orderBy("doc_id").collect()] == [
        zlib.crc32(str(i).encode()) % 5 == 0 for i in range(30)]
    one = fit_quality(docs, labels.where("quality = 1"))
    assert all(r.predicted == 1 for r in classify(docs, one).collect())
    assert fit_quality(docs, labels.limit(0)).scorer()(["x"]) == [0.5]


def test_few_labels_suffice(spark):
    """68 labelled documents: the bad ones fall under the threshold, also those that no model saw."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    rows = classify(docs, fit_quality(docs, labels)).join(labels, "doc_id").collect()
    assert sum(r.predicted == 1 for r in rows if r.quality == 0) <= 1 and sum(r.predicted == 0 for r in rows if r.quality == 1) <= 1


def test_word_features_are_of_each_word_alone():
    s = Settings()
    several = [b"a", "é".encode(), b"word", b"another", b"x" * 500, b"word"]
    buckets, owners = word_features(several, s)
    for i, w in enumerate(several):
        assert sorted(buckets[owners == i].tolist()) == sorted(word_features([w], s)[0].tolist())
        assert (owners == i).sum() == sum(max(len(w) + 3 - n, 0) for n in (2, 3, 4)) + 1
    assert len(word_features([], s)[0]) == 0 and features(None, s)[0].size == 0


def test_score_is_the_softmax_of_the_mean_embedding():
    s = Settings(buckets=512, dims=4, steps=2)
    texts = ["a b c c", "d e f", "!! !!", "g h"]
    model = SubwordClassifier.fit([features(t, s) for t in texts], [1, 1, 0, 0], s)
    for t in texts:
        ids, w = features(t, s)
        z = float(w @ model.logit[ids].astype(float)) + model.bias
        assert model.scorer()(["other", t])[1] == pytest.approx(1 / (1 + np.exp(-z)))


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1))
    for i in range(len(a)):
        for j in range(len(b)):
            s = dc.MATCH if a[i] == b[j] else dc.MISMATCH
            h[i + 1, j + 1] = max(0, h[i, j] + s, h[i, j + 1] + dc.GAP, h[i + 1, j] + dc.GAP)
    return h.max()


def test_alignment_equals_the_plain_recurrence():
    r = np.random.default_rng(1)
    for _ in range(150):
        a, b = r.integers(1, 5, r.integers(1, 12)), r.integers(0, 5, r.integers(0, 25))
        score, first, end = dc.align(a, b)
        assert score == pytest.approx(smith_waterman(a, b))
        assert smith_waterman(a, b[first:end]) == pytest.approx(score)


def test_contaminations_find_exact_and_edited_copies(spark, docs_of, prose):
    items = [prose(n, 100 + n) for n in (12, 25, 40)] + ["too short to align", None, ""]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    edited = items[2].split()
    for i in range(3, 40, 6):
        edited[i] = "changed"
    del edited[20]
    texts = [prose(200, 1) + " " + "".join(c.upper() if c.isascii() else c for c in items[0]) + " " + prose(50, 2), " ".join(edited) + " " + prose(80, 3), prose(3000, 4),
             items[1] + ". " + items[1] + prose(20000, 5), None, "", " ".join(items[2].split()[:8])]
    rows = dc.contaminations(docs_of(texts).withColumn("score", F.lit("clash")), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(0, 0), (1, 2), (3, 1)}
    by = {r.doc_id: r for r in rows}
    assert by[0].score == 1.0 and by[0].first_word == 200 and by[0].end_word == 212
    assert 0.5 <= by[1].score < 1.0
    assert dc.decontaminate(docs_of(texts), benchmark).count() == 4
    assert dc.contaminations(docs_of([]), benchmark).count() == 0
    assert dc.contaminations(docs_of(texts), benchmark.limit(0)).count() == 0


def test_common_items_keep_their_seeds_and_blocks_agree(spark, docs_of, prose, monkeypatch):
    items = [prose(20, 7), prose(30, 8), prose(17, 1009)]
    benchmark = spark.createDataFrame([*enumerate(items), (None, items[0])], "item_id long, text string")
    docs = docs_of([items[0] + " " + prose(10, i) for i in range(40)] + [items[2]])
    want = {(i, k) for i in range(40) for k in (0, None)} | {(40, 2)}
    assert {(r.doc_id, r.item_id) for r in dc.contaminations(docs, benchmark).collect()} == want
    monkeypatch.setattr(dc, "BLOCK_WORDS", 25)
    assert {(r.doc_id, r.item_id) for r in dc.contaminations(docs, benchmark).collect()} == want


@pytest.mark.parametrize("share", [0.05, 0.2, 0.3])
def test_edited_copies_that_the_alignment_accepts_are_found(spark, docs_of, prose, share):
    """Recall against the alignment of every pair: edited copies alone in the corpus, and beside exact ones."""
    import random

    r = random.Random(int(share * 100))
    items = [prose(r.randint(8, 59), 2000 + i) for i in range(120)]
    texts = []
    for i, item in enumerate(items):
        ws = item.split()
        copy = [f"new{r.randint(0, 99)}" if r.random() < share else w for w in ws]
        texts.append(prose(40, 4000 + i) + " " + " ".join(copy) + " " + prose(30, 5000 + i))
    exact = [prose(20, 6000 + i) + " " + item for i, item in enumerate(items) if i % 3 == 0]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in dc.contaminations(docs_of(texts + exact), benchmark).collect()}
    block = dc.Block.of(list(enumerate(items)))
    want = {(i, i) for i, t in enumerate(texts) if dc.align(block.items[i], block.numbers(t))[0] >= 0.5 * len(block.items[i])}
    assert len(want) > 60 and len(want & got) >= (0.99 if share < 0.3 else 0.97) * len(want)
    assert got - want == {(len(items) + k, 3 * k) for k in range(len(exact))}


def test_short_items_are_found_verbatim_and_repeated_items_joined_back(spark, docs_of, prose):
    items = [(1, "Who wrote it?"), (2, "yes"), (3, "one two three four five six seven"), (3, "who WROTE it"), (4, "..."), (None, "yes")]
    benchmark = spark.createDataFrame(items * 3, "item_id long, text string").withColumn("text_id", F.lit("clash"))
    texts = ["so who wrote it then yes", "one two three four five six", "x one two three four five six seven", "who wrote", ""]
    rows = dc.contaminations(docs_of(texts), benchmark).collect()
    assert sorted((r.doc_id, str(r.item_id), r.score, r.first_word, r.end_word) for r in rows) == sorted(
        [(0, "1", 1.0, 1, 4), (0, "3", 1.0, 1, 4), (0, "2", 1.0, 5, 6), (0, "None", 1.0, 5, 6), (2, "3", 1.0, 1, 8)] * 3)
    assert sorted(r.doc_id for r in dc.decontaminate(docs_of(texts), benchmark).collect()) == [0, 1, 3, 4]


def test_contaminations_on_documents_equal_a_text_search(spark):
    import duckdb

    exact = set(duckdb.sql(
        f"SELECT doc_id, item_id FROM '{SF}/documents.parquet' d, '{SF}/benchmark.parquet' b WHERE contains(d.text, b.text)"
    ).fetchall())
    docs, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    assert {(r.doc_id, r.item_id) for r in dc.contaminations(docs, benchmark).where("score = 1").collect()} == exact


def test_training_rows_are_one_of_each_sampled_id(docs_of, prose, spark):
    from ledgerday.llm.classifier import training_rows

    texts = [(i, prose(30, i)) for i in range(40)] + [(7, prose(30, 100 + i)) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    rows = training_rows(docs_of(texts), labels, Settings(), 30).collect()
    kept = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    assert 7 in kept and len(kept) <= 40
    rows = training_rows(docs_of(texts), labels, Settings(), 40).collect()
    assert sorted(r.doc_id for r in rows) == kept
    alone = spark.createDataFrame(docs_of(texts).where("doc_id = 7").collect()).orderBy(F.xxhash64("text")).first().text
    ids, shares = features(alone, Settings())
    seven = next(r for r in rows if r.doc_id == 7)
    assert seven.ids == ids.astype("<i4").tobytes() and seven.shares == shares.astype("<f4").tobytes()


def template_regex(template):
    """A template as a regular expression over blank-separated words, each with a blank behind it."""
    out = []
    for markup, text in re.findall(r"<<(.*?)>>|([^<]+)", template, re.DOTALL):
        if text:
            out += [re.escape(w) + " " for w in re.findall(r"[0-9a-z]+", text)]
        elif markup == "optional":
            out.append("(?:")
        elif markup == "end":
            out.append(")?")
        else:
            low, high = re.search(r'words="(\d+)-(\d+)"', markup).groups()
            match = re.search(r'match="(.*?)"', markup)
            # A word of the text: the pattern must match it in full.
            out.append(f"(?:(?=(?:{match[1] if match else '[^ ]*'}) )[^ ]+ ){{{low},{high}}}")
    return re.compile("".join(out))


@pytest.mark.parametrize("label", ["bsd-2-clause-whole", "bsd-3-clause-whole", "isc-whole", "mit-whole", "zlib-whole", "unlicense-whole", "0bsd-whole", "bsl-1.0-whole"])
def test_whole_license_texts_agree_with_a_regular_expression(label):
    import random

    from ledgerday.llm.licenses import TEMPLATES

    r, scan, pattern = random.Random(label), LicenseScanner(phrases={}, templates={label: TEMPLATES[label]}).scan, template_regex(TEMPLATES[label])
    accepted = 0
    for k in range(60):
        out, depth_off = [], []
        for markup, text in re.findall(r"<<(.*?)>>|([^<]+)", TEMPLATES[label], re.DOTALL):
            if markup == "optional":
                depth_off.append(r.random() < 0.4)
            elif markup == "end":
                depth_off.pop()
            elif any(depth_off):
                continue
            elif text:
                out += text.split()
            else:
                low, high = map(int, re.search(r'words="(\d+)-(\d+)"', markup).groups())
                given = re.search(r'match="\[(\w)', markup)
                out += [given[1] if given and high == 1 else r.choice(["jane", "doe", "the", "authors", "corp"]) for _ in range(r.randint(max(low, 1), high))]
        for _ in range(k % 3):  # one or two words changed, put in or left out
            at = r.randrange(len(out))
            out[at : at + 1] = r.choice([["changed"], [], [out[at], "extra"]])
        text = ["so"] * r.randint(0, 5) + out + ["end"]
        want = [len(text[:0]) + pattern_start for pattern_start in range(len(text)) if pattern.match(" ".join(text[pattern_start:]) + " ")]
        got = [at for _, at, _ in scan(" ".join(text))["places"]]
        assert bool(got) == bool(want) and (not got or got[0] == want[0]), (k, " ".join(text))
        accepted += bool(got)
        assert got == [] or scan(" ".join(text))["score"] == 1.0
    assert 20 <= accepted < 60


def test_whole_texts_give_labels_that_the_base_phrases_dont():
    text = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
    granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
    "AS IS" AND JANE DOE AND CO DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
    MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES
    OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
    TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
    found = LicenseScanner().scan(text)
    assert found["base"] == [] and {p[0] for p in found["places"]} == {"isc-text", "isc-whole"} and found["score"] == 1.0


def test_part_of_a_template_has_its_share_of_the_wording():
    scan = LicenseScanner().scan
    from ledgerday.llm.licenses import TEMPLATES

    half = "permission is hereby granted free of charge to any person obtaining a copy of this software"
    # 16 of the 36 mandatory words of mit-text; and a word that a template starts with is one of its words.
    found = scan("see " + half + " today")
    assert found["places"] == [] and found["score"] == pytest.approx(16 / TemplateAutomaton("x", TEMPLATES["mit-text"]).n_mandatory)
    assert 0 < scan("this program is free")["score"] < 0.3 and scan("nothing of it")["score"] == 0
