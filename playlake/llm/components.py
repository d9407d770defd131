"""Connected components of an edge table, by alternating star contraction.

Each round reads and writes the edge table on shared storage: a large-star step links
every larger neighbour of a node to the smallest one of its neighbourhood, a small-star step
does so for the smaller neighbours.  The rounds end when the edges no longer change; then
every node is linked to its component's smallest node.  A node with very many neighbours
sends its minimum through partial aggregation, and its edges are dealt again by the join, so
no neighbourhood is gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm.common import materialize


def _state(edges: DataFrame) -> tuple:
    """Count and checksum of the edge set."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node``, ``root`` (the smallest node of the component) of every node that has an edge.

    ``edges``: u, v (bigint, not null), in any direction, repeated or not.
    """
    current = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                          .distinct(), "edges")
    state = _state(current)
    for _ in range(max_rounds):
        if not state[0]:
            break
        # large star: larger neighbours go to the smallest of the neighbourhood
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: a node's smaller neighbours, and the node, go to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(least, "u")
        small = (linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        current = materialize(small, "edges")
        before, state = state, _state(current)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
