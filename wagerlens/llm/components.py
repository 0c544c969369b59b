"""Connected components of an edge list, by rounds of joins with stored intermediates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.llm.common import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node next to it (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (
        both.filter("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    neighbours = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return neighbours.unionByName(own).filter("a <> b").distinct()


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """node, component (smallest node it can reach) for every node of an edge (a, b).

    Alternates large-star and small-star steps until all edges point straight at the smallest
    node; the number of rounds grows with the logarithm of the longest path. Every round is
    written to the shared folder, so a lost executor repeats tasks of one round at most. Nodes
    are longs; an edge from a node to itself says nothing.
    """
    current = store(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    mark = _mark(current)
    for _ in range(max_rounds):
        current = store(_small_star(_large_star(current)), "edges")
        before, mark = mark, _mark(current)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """Changes whenever the edge list does."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.shiftright(h, 20))).first())
