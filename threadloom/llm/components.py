"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.sizing import dealt_anew
from ..session import cut_lineage


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    every = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = every.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(dealt_anew(least, "a").alias("u"), F.least("a", "m").alias("m"))
    moved = every.where("b > a").join(least, F.col("a") == F.col("u"))
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of these; ``a > b`` in all edges."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(dealt_anew(least, "a").alias("u"), "m")
    moved = edges.join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(own).where("a <> b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 64) -> DataFrame:
    """``(node, root)`` for every node of an edge; ``root`` is the smallest node of its component.

    Every round is two stars, each an aggregate and a join whose skewed side
    (the edges of a hub) adaptive execution splits; its result is checkpointed.
    The edges become stars around the roots after a number of rounds that grows
    with the logarithm of the longest path.  The loop ends when a round changes
    nothing, told by the number of edges and a sum of hashes; not ending within
    ``most_rounds`` is an error.  Null ends are ignored.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    now = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = cut_lineage(now.select(high.alias("a"), low.alias("b")).distinct())
    mark = None
    for _ in range(most_rounds):
        digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        seen = tuple(now.agg(F.count("*"), digest).first())
        if seen == mark or not seen[0]:
            break
        mark = seen
        now = cut_lineage(_small(_large(now)))
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    own = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(own)
