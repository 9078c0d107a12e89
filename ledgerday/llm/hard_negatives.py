"""Hard-negative mining with bounds along a spanning tree of the anchors.

Scores are integer inner products.  The anchors of a block are the nodes of a
minimum spanning tree by distance.  A candidate's score with an anchor is
within (length of the edge) x (candidate's norm) of its score with the anchor's
parent, so a candidate is scored anew only where those bounds overlap what is
looked for; where they don't, the bounds go on to the anchor's children.

Blocks of anchors meet groups of candidates in tasks of one block and one group
each, so no task holds all of either, and only the best few of each anchor leave a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerday.llm.common import shared_table

POSITIVES, NEGATIVES = 5, 3
#: Hundredths of the positive's score that a negative's lies between.
WINDOW = (50, 95)
#: Anchors of a block, candidates of a group, and candidates scored at a time.
BLOCK, GROUP, CHUNK = 1024, 65_536, 8192
#: Fewer candidates are dealt to this many groups, so that the work is spread.
GROUPS = 32
_NO_ID = np.iinfo(np.int64).max

Best = list[tuple[int, int]]  # (-score, id), best first


class Tree:
    """Anchors of a block in an order in which each comes behind its parent."""

    def __init__(self, table: pa.Table):
        order = np.argsort(table["place"].to_numpy())
        self.place = table["place"].to_numpy()[order]
        self.ids, self.labels = table["id"].to_numpy()[order], table["label"].to_numpy()[order]
        self.vectors = matrix(table["vector"])[order]
        self.parent, self.edge = table["parent"].to_numpy()[order], table["edge"].to_numpy()[order]

    def walk(self, candidates: np.ndarray, look: Callable[[int, np.ndarray, np.ndarray, Callable], np.ndarray]) -> int:
        """``look(i, low, high, score)`` for each anchor, with bounds on all candidates' scores;
        ``score(rows)`` gives exact ones.  Returns how many scores were worked out."""
        width = max(candidates.shape[1], self.vectors.shape[1])
        x, anchors = widened(candidates, width), widened(self.vectors, width)
        exact = float(np.abs(x).max(initial=0)) * float(np.abs(anchors).max(initial=0)) * max(width, 1) < 2**53
        kind = np.float64 if exact else object  # sums of doubles are exact below 2^53
        x, anchors = x.astype(kind), anchors.astype(kind)
        norms = np.sqrt((x * x).sum(1).astype(float)) if exact else None
        children = np.bincount(self.parent[self.parent >= 0], minlength=len(anchors))
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        scored = 0
        for i, anchor in enumerate(anchors):
            parent = self.parent[i]
            if parent < 0 or not exact:
                low = (x @ anchor if len(x) else np.zeros(0, kind))
                high = low
                scored += len(x)
                look(i, low, high, lambda rows: low[rows])
            else:
                low, high = known[parent]
                slack = norms * (self.edge[i] * (1 + 1e-9)) + 1e-6
                low, high = low - slack, high + slack
                asked: list[np.ndarray] = []

                def score(rows: np.ndarray) -> np.ndarray:
                    asked.append(rows)
                    low[rows] = high[rows] = x[rows] @ anchor
                    return low[rows]

                look(i, low, high, score)
                scored += sum(map(len, asked))
            if parent >= 0:
                children[parent] -= 1
                if not children[parent]:
                    known.pop(parent, None)
            if children[i]:
                known[i] = low, high
        return scored


def matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    lists = vectors.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def widened(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def spanning_tree(table: pa.Table) -> pa.Table:
    """The rows with ``place`` (an order from the root), ``parent`` (a place; -1: the root's) and ``edge`` (its length)."""
    order = np.lexsort((table["label"].to_numpy(), table["id"].to_numpy()))  # the same tree whenever a lost task runs again
    table = table.take(pa.array(order))
    x = matrix(table["vector"]).astype(float)
    n = len(x)
    place, parent, edge = np.zeros(n, int), np.full(n, -1), np.zeros(n)
    left = np.ones(n, bool)
    near, distance = np.full(n, -1), np.full(n, np.inf)
    at = 0
    for step in range(n):
        place[at], left[at] = step, False
        if step:
            parent[at], edge[at] = place[near[at]], distance[at]
        own = np.sqrt(((x - x[at]) ** 2).sum(1))
        closer = left & (own < distance)
        distance[closer], near[closer] = own[closer], at
        if left.any():
            at = int(np.argmin(np.where(left, distance, np.inf)))
    for name, column in (("place", place), ("parent", parent), ("edge", edge)):
        table = table.append_column(name, pa.array(column))
    return table


def _best(found: Best, scores: np.ndarray, ids: np.ndarray, count: int) -> Best:
    return sorted([*found, *zip((-scores).tolist(), ids.tolist())])[:count]


def _rows_by_label(labels: np.ndarray) -> dict[int, np.ndarray]:
    order = np.argsort(labels, kind="stable")
    different, starts = np.unique(labels[order], return_index=True)
    return dict(zip(different.tolist(), np.split(order, starts[1:])))


def _chunks(table: pa.Table) -> Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for at in range(0, table.num_rows, CHUNK):
        part = table.slice(at, CHUNK)
        yield part["id"].to_numpy(), part["label"].to_numpy(), matrix(part["vector"])


def best_positives(tree: Tree, candidates: pa.Table, count: int = POSITIVES) -> list[Best]:
    """For each anchor the best ``count`` of the candidates with its label, those with its id left out."""
    found: list[Best] = [[] for _ in tree.ids]
    for ids, labels, x in _chunks(candidates):
        of_label = _rows_by_label(labels)

        def look(i: int, low: np.ndarray, high: np.ndarray, score) -> None:
            rows = of_label.get(int(tree.labels[i]), np.zeros(0, int))
            rows = rows[ids[rows] != tree.ids[i]]
            if not len(rows):
                return
            sure = np.sort(low[rows])[-count:].tolist() + [-s for s, _ in found[i]]
            # At least ``count`` candidates reach the count-th of these.
            least = sorted(sure, reverse=True)[count - 1] if len(sure) >= count else -np.inf
            rows = rows[high[rows] >= least]
            found[i] = _best(found[i], score(rows), ids[rows], count)

        tree.walk(x, look)
    return found


def best_negatives(
    tree: Tree, positive_scores: list[list[int]], candidates: pa.Table, count: int = NEGATIVES, window: tuple[int, int] = WINDOW
) -> list[list[Best]]:
    """For each anchor and positive score the best ``count`` of the candidates of other labels in its window."""
    found: list[list[Best]] = [[[] for _ in scores] for scores in positive_scores]
    for ids, labels, x in _chunks(candidates):
        of_other = {label: np.flatnonzero(labels != label) for label in set(tree.labels.tolist())}

        def look(i: int, low: np.ndarray, high: np.ndarray, score) -> None:
            others = of_other[int(tree.labels[i])]
            lo, hi = low[others], high[others]
            wanted = np.zeros(len(others), bool)
            for best, positive in zip(found[i], positive_scores[i]):
                least, most = window[0] * positive, window[1] * positive
                overlap = (100 * hi >= least) & (100 * lo <= most)
                inside = (100 * lo >= least) & (100 * hi <= most)
                sure = np.sort(lo[inside])[-count:].tolist() + [-s for s, _ in best]
                if len(sure) >= count:
                    overlap &= hi >= sorted(sure, reverse=True)[count - 1]
                wanted |= overlap
            rows = others[wanted]
            if not len(rows):
                return
            exact = score(rows)
            for n, positive in enumerate(positive_scores[i]):
                inside = (100 * exact >= window[0] * positive) & (100 * exact <= window[1] * positive)
                found[i][n] = _best(found[i][n], exact[inside], ids[rows[inside]], count)

        tree.walk(x, look)
    return found


def _long(values: list) -> pa.Array:
    """64-bit integers; what lies beyond is cut to the range."""
    return pa.array([None if v is None else int(max(min(v, _NO_ID), -_NO_ID - 1)) for v in values], pa.int64())


def mine(
    vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW, block: int = BLOCK, group: int = GROUP, groups: int = GROUPS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors``: ``id`` (long), ``label`` (int), ``vector`` (array<long>); ``anchor`` says which rows
    are anchors.  Higher scores come first, ties by smaller id, null ids last.  Of an
    anchor's rows of the same label (without those of its own id) the first
    ``positives`` are its positives; for each, the first ``negatives`` of the rows of other labels
    whose score is within ``window`` hundredths of the positive's, ``rank`` from 1.

    Rows with a null label, vector or component take no part.  Rows repeated in full count once;
    rows of one id that differ are rows of their own, also as anchors.  A null id is no anchor.
    Shorter vectors are filled up with zeros.  No anchor, positive or negative: no row.  Scores beyond
    64 bits are exact but cut in the result.  Other columns are ignored.
    """
    rows = vectors.where("label is not null and vector is not null and forall(vector, x -> x is not null)")
    rows = rows.select("id", F.col("label").cast("int").alias("label"), "vector").distinct()
    rows = rows.withColumn("anchor", F.coalesce(anchor, F.lit(False)) & F.col("id").isNotNull())
    rows = shared_table(rows.withColumn("id", F.coalesce("id", F.lit(int(_NO_ID)))), "vectors")
    n, n_anchors = rows.agg(F.count("*"), F.count_if("anchor")).first()
    if not n_anchors:
        schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return vectors.sparkSession.createDataFrame([], schema)
    n_blocks, n_groups = -(-n_anchors // block), max(-(-n // group), min(groups, -(-n // 512)))

    def dealt(parts: int) -> Column:
        return F.pmod(F.xxhash64("id", "label", "vector"), F.lit(parts)).cast("int")

    tree = "id long, label int, vector array<long>, block int, place long, parent long, edge double"
    anchors = rows.where("anchor").select("id", "label", "vector", dealt(n_blocks).alias("block"))
    anchors = shared_table(anchors.groupBy("block").applyInArrow(spanning_tree, tree), "anchors")
    blocks, numbers = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))), F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))
    candidates = rows.select("id", "label", "vector", dealt(n_groups).alias("group"), blocks.alias("block"))
    key = ("block", "group")

    def positives_in(left: pa.Table, right: pa.Table) -> pa.Table:
        t = Tree(left) if left.num_rows else None
        out = [
            (left["block"][0].as_py(), p, i, -s) for p, best in zip(t.place.tolist(), best_positives(t, right, positives)) for s, i in best
        ] if t is not None and right.num_rows else []
        block_, place, ids, scores = zip(*out) if out else ((),) * 4
        return pa.table({"block": pa.array(block_, pa.int32()), "place": _long(place), "positive_id": _long(ids), "positive_score": _long(scores)})

    met = anchors.withColumn("group", numbers).groupBy(*key).cogroup(candidates.groupBy(*key))
    found = met.applyInArrow(positives_in, "block int, place long, positive_id long, positive_score long")
    first = Window.partitionBy("block", "place").orderBy(F.desc("positive_score"), "positive_id")
    found = found.withColumn("slot", F.row_number().over(first)).where(F.col("slot") <= positives)
    chosen = found.groupBy("block", "place").agg(F.sort_array(F.collect_list(F.struct("slot", "positive_id", "positive_score"))).alias("positives"))
    searching = shared_table(anchors.join(chosen, ["block", "place"], "left"), "anchors-with-positives")

    def negatives_in(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            left = left.take(pa.array(np.argsort(left["place"].to_numpy())))
            t, chosen = Tree(left), [p or [] for p in left["positives"].to_pylist()]
            scores = [[p["positive_score"] for p in ps] for ps in chosen]
            for i, (ps, bests) in enumerate(zip(chosen, best_negatives(t, scores, right, negatives, window))):
                for p, best in zip(ps, bests):
                    out += [(left["block"][i].as_py(), t.place[i], p["slot"], t.ids[i], p["positive_id"], p["positive_score"], j, -s) for s, j in best]
        columns = zip(*out) if out else ((),) * 8
        names = ["block", "place", "slot", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        return pa.table({k: _long(list(c)).cast(pa.int32()) if k in ("block", "slot") else _long(list(c)) for k, c in zip(names, columns)})

    met = searching.withColumn("group", numbers).groupBy(*key).cogroup(candidates.groupBy(*key))
    schema = "block int, place long, slot int, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = met.applyInArrow(negatives_in, schema)
    first = Window.partitionBy("block", "place", "slot").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(first).cast("int")).where(F.col("rank") <= negatives)
    none = F.lit(int(_NO_ID))
    return found.select(
        "anchor_id", F.nullif("positive_id", none).alias("positive_id"), "rank", F.nullif("negative_id", none).alias("negative_id"),
        "positive_score", "negative_score",
    )


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """``id, label, vector`` of rows whose vector is given and finite throughout: components
    ``floor(256 * x)``; labels of ids divisible by 7 move on to the next of ten."""
    finite = "embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return embeddings.where(finite).select(
        F.col("vec_id").cast("long").alias("id"), label.cast("int").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("vector"),
    )
