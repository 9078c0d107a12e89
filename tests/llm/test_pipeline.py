"""The pipeline's stages, each against its own input."""

import sys
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from ledgerday.llm.common import shared_table

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "ngram_join", "benchmark_decontamination", "packing"]
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = shared_table(stage(spark, kept, SF), name)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        before, after = kept.count(), out.count()
        assert 0 < after <= before, name
        kept = out
    ids = {r.doc_id for r in kept.collect()}
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in packed} == ids
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert sum(labels.get(i) == 0 for i in ids) <= 2


ODD = [(None, None), (1, None), (2, ""), (3, " \n\t"), (3, " \n\t"), (None, "one two"), (4, "!!! ..."), (5, "日本 語")]


@pytest.fixture
def odd_docs(docs_of, prose):
    """Nulls, empty, blank and long texts, ties, repeated rows and columns with the stages' own names."""
    long = prose(20_000, 90)
    rows = [*ODD, (6, long), (7, prose(60, 91)), (7, prose(60, 91)), (None, prose(60, 92))]
    docs = docs_of(rows)
    for name in ("id", "row", "class", "key", "score", "dropped", "__row", "text_id", "length", "loss"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


def texts_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_take_odd_rows(spark, odd_docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, odd_docs, SF)
    assert out.columns == odd_docs.columns and stage(spark, odd_docs.limit(0), SF).count() == 0
    before, after = texts_of(odd_docs), texts_of(out)
    if name == "quality_classifier":
        assert after == [x for x in before if x in after] and {7, 6} <= {i for i, _ in after}  # prose stays, repeated rows alike
        assert len({x[1] for x in before if not (x[1] or "").strip()} & {x[1] for x in after}) in (0, 3)  # no words: all or none
    elif name == "ngram_join":
        assert after == sorted([*map(tuple, before[:0]), *[x for x in before if not x[1]], *{x for x in before if x[1]}], key=str)
    elif name == "line_dedup":
        assert after == before  # lines of rows repeated in full stay in each
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out.collect())
    else:
        assert after == before


def test_packing_takes_odd_rows(spark, odd_docs):
    rows = corpus_pipeline.packing(spark, odd_docs, SF).collect()
    assert Counter(r.doc_id for r in rows if r.start == 0) == Counter(r.doc_id for r in odd_docs.collect())
    assert corpus_pipeline.packing(spark, odd_docs.limit(0), SF).count() == 0


def test_texts_that_lose_every_line_go(spark, docs_of, prose):
    a, b = prose(40, 95), prose(40, 96)
    rows = [(1, a + "\n" + b), (2, b + "\n\n" + a), (3, b + "\nand a line of its own, long enough to stay"), (4, "\n")]
    got = texts_of(corpus_pipeline.line_dedup(spark, docs_of(rows), SF))
    assert got == [(1, a + "\n" + b), (3, "and a line of its own, long enough to stay"), (4, "\n")]


def test_entry_registers_every_operator():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
    assert "pyspark" in sys.modules


def test_join_stage_keeps_one_row_of_each_class(spark, docs_of, prose):
    a, b, c, d = (prose(200, k) for k in (31, 32, 33, 34))
    rows = [(None, a), (None, b), (None, b + " extra"), (None, b), (None, c), (5, c + " extra"), (5, c + " extra"),
            (7, d), (7, d), (7, d + " extra"), (8, d), (None, None), (None, ""), (9, None)]
    out = [(r.doc_id, r.text) for r in corpus_pipeline.ngram_join(spark, docs_of(rows), SF).collect()]
    assert sorted(out, key=str) == sorted(set(out), key=str) and out.count((None, a)) == 1
    assert sum(t in (b, b + " extra") for _, t in out) == 1 and (5, c + " extra") in out
    assert [i for i, t in out if t in (d, d + " extra")] == [7] and len(out) == 7
    assert {(None, None), (None, ""), (9, None)} <= set(out)


def test_stages_hold_arrow_batches_and_keep_smaller_ones(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.createDataFrame([(1, "a b c\nd e f", "en", "s", 11)], "doc_id long, text string, lang string, source string, n_chars long")
    try:
        for given, held in (("10000", 1000), ("0", 1000), ("7", 7)):
            spark.conf.set(key, given)
            dict(corpus_pipeline.STAGES)["packing"](spark, docs, "")
            assert int(spark.conf.get(key)) == held
    finally:
        spark.conf.set(key, before)
