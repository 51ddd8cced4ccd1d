"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One round: the neighbours of each node move to the smallest of them.

    ``larger`` moves the neighbours above the node, otherwise those below it
    and the node itself.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not larger:
        both = both.where("b < a")
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    joined = both.join(low, "a")
    moved = joined.where("b > a").select("b", "low") if larger else joined.select("b", "low").union(low.select("a", "low"))
    return moved.toDF("a", "b").where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, root): every node that has an edge, with the smallest node it can reach.

    Rounds are written tables; a round that changes nothing is the last.  Each
    node of a large group is one row of a hash-joined table, never a list.
    """
    edges, before = stored(edges.select("a", "b").where("a <> b").distinct()), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, last = now, edges
        edges = stored(_star(_star(edges, True), False))
        discard(last)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
