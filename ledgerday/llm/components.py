"""Connected components by rounds of large and small stars, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerday.llm.common import drop_tables, shared_table


def _star(links: DataFrame, small: bool) -> DataFrame:
    """Every node's larger (or, in a small star, also its own and smaller) neighbours
    are linked to its smallest neighbour.

    The smallest neighbour is a combined minimum joined back, so a node with a
    third of all links needs no task of its own.
    """
    if small:
        near = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        near = links.union(links.select("v", "u"))
    low = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    linked = near.join(low, "u")
    if small:
        # u itself goes to its smallest neighbour, and so do its other smaller neighbours.
        out = linked.select(F.col("v").alias("u"), F.col("low").alias("v")).union(low.select("u", F.col("low").alias("v")))
    else:
        out = linked.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return out.where("u <> v").distinct()


def _stars(links: DataFrame) -> bool:
    """Whether each ``u`` has one ``v``, and no ``v`` is also a ``u``."""
    ends = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.lit(None).cast("long")))
    # A centre has only nulls, any other node only its one v.
    mixed = F.min("v").isNotNull() & ((F.min("v") < F.max("v")) | (F.count("v") < F.count("*")))
    return ends.groupBy("u").agg(mixed.alias("mixed")).where("mixed").isEmpty()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``id, class`` of every node of ``links`` (two long columns): the smallest id that it is
    connected with.

    Stars until every node has one link, to a centre without one: a number of
    rounds that grows with the logarithm of the longest chain.  Each round is a
    written table; the driver sees only whether it is the last.  Null ends and links of a node
    with itself are left out; repeated links count once; no links: no rows.
    """
    u, v = links.columns[:2]
    links = links.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v"))
    links = links.where("u is not null and v is not null and u <> v").distinct()
    links = shared_table(links, name)
    while not _stars(links):
        before, links = links, shared_table(_star(_star(links, small=False), small=True), name)
        drop_tables(before)
    members = links.select(F.col("u").alias("id"), F.col("v").alias("class"))
    return members.union(links.select(F.col("v").alias("id"), F.col("v").alias("class")).distinct())
