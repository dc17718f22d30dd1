"""Connected components of an undirected graph held as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import join_hot, remove, written

#: Edges from which on a node with many is split among tasks; below, a task takes any node's.
SPLIT_EDGES = 5_000_000


def with_least(edges: DataFrame, split: bool) -> DataFrame:
    """``edges`` with ``m``, the least neighbour of each ``a``; a hub's edges spread over tasks if ``split``."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("_n"))
    return join_hot(edges, written(low, "least"), "a", "_n").select("a", "b", "m") if split else edges.join(low.select("a", "m"), "a")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node``, ``root`` for every node of ``edges`` (columns ``a``, ``b``); a root is its component's smallest node.

    Alternates the large-star and small-star steps, whose number grows with
    the logarithm of a component's size.  Each round's edges are written to
    the shared folder, so a lost executor costs a round at most.
    """
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        split = state is None or state[0] > SPLIT_EDGES
        split = split and e.limit(SPLIT_EDGES + 1).count() > SPLIT_EDGES
        large = with_least(both, split).withColumn("m", F.least("m", "a"))
        large = large.where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        linked = with_least(written(large, "large") if split else large, split)
        small = linked.select("a", F.col("m").alias("b")).unionByName(linked.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        previous, e = e, written(small, "edges")
        got = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        remove(previous)
        if got == state:
            break
        state = got
    else:
        raise RuntimeError(f"components didn't settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
