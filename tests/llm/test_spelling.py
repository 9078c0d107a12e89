"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerday.llm.spelling import Acceptor, near_pairs, spelling_variants, word_forms

SF = "/root/testdata/sf0.001"


def one_edit(x, y):
    if abs(len(x) - len(y)) > 1 or x == y:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    x, y = sorted((x, y), key=len)
    return any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def brute_forms(counts):
    """Each word's near words by trying every deletion."""
    out, holes = {}, {}
    for w in counts:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1 :]), []).append(w)
    for w, n in counts.items():
        near = {y for i in range(len(w)) for y in holes[w[:i], w[i + 1 :]]}
        near |= {y for i in range(len(w) + 1) for y in holes.get((w[:i], w[i:]), ())}
        near |= {w[:i] + w[i + 1 :] for i in range(len(w))} & counts.keys()
        near -= {w}
        best = min(near, key=lambda y: (-counts[y], y), default=None)
        out[w] = (best if best and counts[best] >= 2 * n else None, len(near))
    rows = set()
    for w, (form, n_near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, counts[w], n_near, counts[form] if form else None))
    return rows


def brute_counts(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def rows_of(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_words(seed, n, alphabet="abç", longest=9):
    r = random.Random(seed)
    return sorted({"".join(r.choices(alphabet, k=r.randint(5, longest))) for _ in range(n)})


def test_acceptor_is_minimal_and_composes_each_pair_once():
    words = random_words(1, 300)
    a = Acceptor(words)
    # States that accept the same words are one state.
    behind = {w[i:]: set() for w in words for i in range(len(w) + 1)}
    languages = {frozenset(v[len(p):] for v in words if v.startswith(p)) for p in {w[:i] for w in words for i in range(len(w) + 1)}}
    assert len(a.edges) == len(languages) and behind
    for m in range(5, 10):
        got = list(a.one_edit_pairs(m))
        want = {(x, y) for x in words if len(x) == m for y in words if one_edit(x, y) and (len(y) > m or (len(y) == m and x < y))}
        assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("max_group", [20_000, 3])
def test_pairs_are_met_once_however_partitions_are_dealt(spark, max_group):
    words = [*random_words(2, 120), "aaaaa", "aaaaaa", "aaaaaaa", "x" * 300, "x" * 301, "x" * 150 + "y" + "x" * 149]
    got = [frozenset(r) for r in near_pairs(spark.createDataFrame([(w, 3) for w in words], "word string, n long"), max_group).collect()]
    want = {frozenset((x, y)) for x in words for y in words if one_edit(x, y)}
    assert len(got) == len(set(got)) and set(got) == want


def test_forms_and_roots_equal_brute_force(spark):
    r = random.Random(3)
    counts = {w: r.choice([3, 3, 4, 6, 8, 12, 30, 100]) for w in random_words(4, 250)}
    counts |= {"aaaaa" + "b" * i: 3 * 2**i for i in range(1, 9)}  # a long chain of forms
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(word_forms(df)) == brute_forms(counts)


def test_query_equals_brute_force(spark):
    from ledgerday.llm.queries import QUERIES

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_forms(brute_counts([(r.doc_id, r.text) for r in docs.collect()]))
    got = QUERIES["op11_spelling_variants"](spark, SF)
    assert got.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    assert rows_of(got) == want and sum(r[1] is not None for r in want) > 50


def test_edge_rows(spark, docs_of):
    long = "Straße schön ÀÉÎ÷× naïve " * 3000 + "z" * 5_000 + " " + "z" * 5_000 + "\n" + "z" * 5_000
    rows = [(None, "alpha alpha alphas alpha"), (None, None), (3, ""), (3, None), (4, "Alpha ALPHA alphas,alphas\0alphas"), (4, "日本 alphä alphä alphä"), (5, long), (5, long)]
    docs = docs_of(rows)
    assert rows_of(spelling_variants(docs)) == brute_forms(brute_counts(rows))
    other = docs.withColumn("word", F.lit("w")).withColumn("n", F.lit(1)).withColumn("form", F.lit(1))
    assert rows_of(spelling_variants(other)) == rows_of(spelling_variants(docs))
    assert rows_of(spelling_variants(docs.limit(0))) == set()
    assert rows_of(spelling_variants(docs_of([(1, None)]))) == set()
