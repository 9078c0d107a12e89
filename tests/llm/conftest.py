import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def docs_of(spark):
    """Documents from texts (ids from 0) or (id, text) pairs."""

    def make(rows, lang="en"):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t in rows], DOCS)

    return make


@pytest.fixture
def prose():
    """Reproducible texts of n words."""
    import random

    def make(n, seed=0, stop=9):
        r = random.Random(seed)
        out = []
        for i in range(n):
            w = "".join(r.choice("abcdefghijklmnopqrstuvwxyzéü") for _ in range(r.randint(2, 9)))
            out.append(w + ("." if i % stop == stop - 1 else ""))
        return " ".join(out)

    return make
