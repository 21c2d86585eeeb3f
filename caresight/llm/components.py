"""Connected components by alternating large and small stars (hub nodes split by ``join_by_key``)."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from caresight.llm.common import checkpointed, join_by_key


def _ordered(edges: DataFrame, a: str, b: str) -> DataFrame:
    return edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where("lo < hi").distinct()


def _state(edges: DataFrame) -> tuple:
    """Two numbers that change when the set of edges does."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node reachable.

    No neighbourhood is ever gathered: a node's smallest neighbour is an aggregate, and it goes
    back to the node's edges by ``join_by_key``. Each round is cut by a reliable checkpoint.
    """
    edges = checkpointed(_ordered(edges, a, b))
    before, now = None, _state(edges)
    while now != before:
        # large star: all larger neighbours of a node move to the smallest of its neighbourhood
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(edges.select("hi", "lo"))
        least = checkpointed(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n")))
        edges = checkpointed(_ordered(join_by_key(both.where("v > u"), least, ["u"], 2 * now[0]), "v", "m"))
        # small star: smaller neighbours and the node itself move to the smallest of them
        least = checkpointed(edges.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"), F.count("*").alias("n")))
        down = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        moved = join_by_key(down, least, ["u"], now[0])
        edges = checkpointed(_ordered(moved.select("v", "m").union(least.select("u", "m")), "v", "m"))
        before, now = now, _state(edges)
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        edges.select("lo", "lo").distinct())
