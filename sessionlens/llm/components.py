"""Connected components of a graph given as a table of edges.

Alternating stars: every node links its larger neighbours to the smallest node it knows,
then itself and its smaller neighbours. Each step is a partial aggregation and a join on
the node, so a node with very many neighbours is not gathered in one task; the rounds
grow with the logarithm of the longest chain. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.staging import discard, stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    known = _both_ways(edges)
    least = known.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    linked = known.filter(F.col("b") > F.col("a")).join(least, "a")
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").filter(F.col("b") != F.col("m"))
    moved = linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that `edges` (a, b) link to a smaller one.

    The root is the smallest node of a component; it has no row of its own.
    """
    edges = stage(edges.filter(F.col("a") != F.col("b")).distinct(), "edges")
    seen = _digest(edges)
    while seen[0]:
        further = stage(_small_star(_large_star(edges)).distinct(), "edges")
        found = _digest(further)
        discard(edges)
        edges = further
        if found == seen:
            break
        seen = found
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
