"""Connected components of a distributed edge list by alternating large-star and small-star steps.

Edges stay rows; each step is a group-by with map-side minimum and a join, so a hub with a third
of all edges is combined before the shuffle and split by the skew join. Steps are cut by written
tables. The number of steps grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(pairs: DataFrame) -> DataFrame:
    """Join each node's pairs (u, v) with the smallest of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame, max_steps: int = 60) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b); the root is the smallest node of the component."""
    current = Stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    state = _state(current.df)
    for _ in range(max_steps):
        both = current.df.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            current.df.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        starred = _star(down)
        small = starred.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            starred.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()
        following = Stored(small, "edges")
        current.drop()
        current, before, state = following, state, _state(following.df)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return current.df.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        current.df.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
