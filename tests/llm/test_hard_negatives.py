"""Hard-negative mining against brute force and its SQL."""

import math
import random

import pyarrow as pa
import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from ledgerday.llm.hard_negatives import Tree, integer_vectors, mine, spanning_tree
from ledgerday.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
EMBEDDINGS = "vec_id long, embedding array<float>, label int"


def brute(rows, step=50):
    kept = []
    for i, v, label in {(i, None if v is None else tuple(v), l) for i, v, l in rows}:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        kept.append((i, [math.floor(256 * x) for x in v], label))
    out = []
    rank = lambda x: (-x[1], x[0] is None, x[0] or 0)
    for i, v, label in kept:
        if i is None or i % step:
            continue
        scored = [(j, sum(a * b for a, b in zip(v, w)), other) for j, w, other in kept]
        positives = sorted((x for x in scored if x[2] == label and x[0] != i), key=rank)[:5]
        for p, ps, _ in positives:
            fit = sorted((x for x in scored if x[2] != label and 50 * ps <= 100 * x[1] <= 95 * ps), key=rank)[:3]
            out += [(i, p, n, j, ps, s) for n, (j, s, _) in enumerate(fit, 1)]
    return sorted(out, key=str)


def mined(df, **sizes):
    return sorted(map(tuple, mine(integer_vectors(df), F.col("id") % 50 == 0, **sizes).collect()), key=str)


def clustered(seed, n, dims=8):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    # Rounded to halves, so that scores tie; few labels for many rows.
    return [(i, [round(2 * (c + r.gauss(0, 0.2))) / 2 for c in r.choice(centres)], r.randint(0, 4)) for i in range(n)]


@pytest.mark.parametrize("sizes", [{}, {"block": 4, "group": 100, "groups": 3}])
def test_clusters_and_ties_equal_brute_force(spark, sizes):
    rows = clustered(1, 900)
    assert mined(spark.createDataFrame(rows, EMBEDDINGS), **sizes) == brute(rows)


def test_tree_bounds_spare_scores():
    """Anchors near each other: most candidates far from the window aren't scored."""
    r = random.Random(2)
    anchors = [[100 + r.randint(-2, 2) for _ in range(16)] for _ in range(50)]
    table = pa.table({"id": pa.array(range(50)), "label": pa.array([0] * 50, pa.int32()), "vector": anchors, "block": pa.array([0] * 50, pa.int32())})
    tree = Tree(spanning_tree(table))
    assert sorted(tree.place.tolist()) == list(range(50)) and all(p < i for i, p in zip(tree.place, tree.parent))
    import numpy as np

    x = np.array([[r.randint(-100, 100) for _ in range(16)] for _ in range(2000)])

    def look(i, low, high, score):
        exact = x @ tree.vectors[i]
        assert (low <= exact).all() and (exact <= high).all()
        score(np.flatnonzero(high >= np.sort(low)[-5]))

    assert tree.walk(x, look) < 0.2 * 50 * 2000


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = clustered(3, 200) + [(0, [1.0] * 8, 1), (50, [0.5] * 8, 2), (50, [0.5] * 8, 2), (None, [1.0] * 8, 1), (None, [0.9] * 8, 3)]
    rows += [(300, None, 1), (350, [1.0] * 8, None), (400, [inf] + [0.0] * 7, 1), (450, [nan] * 8, 1), (500, [None, 1.0], 1)]
    rows += [(550, [1.0, 2.0], 2), (600, [], 3), (650, [-1.0] * 8, 4), (700, [0.0] * 8, 4)]
    df = spark.createDataFrame(rows, EMBEDDINGS)
    assert mined(df) == brute(rows)
    extra = df.withColumn("anchor", F.lit("x")).withColumn("block", F.lit(1)).withColumn("place", F.lit(1)).withColumn("rank", F.lit(1))
    assert mined(extra) == brute(rows)
    assert mined(df.limit(0)) == [] and mined(df.where("vec_id = 1")) == [] and mined(df.where("vec_id = 600")) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [2.0 ** (20 + i % 3) + i, -(2.0 ** 21), 3.0 * i], i % 2) for i in range(0, 120, 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert mined(df) == brute(rows)


def test_query_equals_sql(spark):
    problems, n, _, _ = compare(spark, duck(SF), "op12", QUERIES["op12_hard_negatives"], ORACLE_SQL["op12_hard_negatives"], SF)
    assert not problems and n > 20
