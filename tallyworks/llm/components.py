"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.store import save


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them. Edges run downwards."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    kept = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node that has an edge; the root is the smallest node it can reach.

    Alternating large and small stars (Kiveris et al., 2014): joins and
    grouped minima only, a number of rounds that grows with the logarithm of the
    longest path. Every round is written to the shared folder. Minima are
    combined before the shuffle, and the joins keep one row per edge, so a node
    with very many edges costs one row per task and a splittable join.
    Loops, repeated edges and edges with a null end do no harm; no edges give
    an empty table.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = save(edges.where(F.col("u") > F.col("v")).distinct(), "edges")
    before = None
    while before != (now := _fingerprint(edges)):
        before = now
        if not now[0]:
            break
        edges = save(_small_star(_large_star(edges).distinct()), "stars")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
