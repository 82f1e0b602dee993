"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.stats import scalars
from shelfwise.staging import stage


def _fingerprint(edges: DataFrame) -> tuple:
    """Order-free summary of an edge set, to see that a round changed nothing."""
    row = scalars(edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")))
    return row["n"], row["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(
        F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    side = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    own = least.select("u", F.col("m").alias("v"))
    return side.unionByName(own).distinct()


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) for ``nodes(node)`` and ``edges(u, v)``; a component is its least node.

    Each round is written out, so lineage stays short. The number of rounds
    grows with the logarithm of the component sizes.
    """
    current = stage(edges.select("u", "v").where("u <> v").distinct(), "edges")
    seen = _fingerprint(current)
    while seen[0]:
        current = stage(_small_star(_large_star(current)), "edges")
        now = _fingerprint(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.join(roots, "node", "left").select(
        "node", F.coalesce("root", "node").alias("component"))
