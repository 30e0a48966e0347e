"""Connected components of an edge table by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridops.llm.common import stage


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1] or 0


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges (a, b)``: the smallest node it is linked to.

    Each round hangs the larger neighbours of a node on its smallest neighbour, then
    the node's smaller neighbours likewise, until nothing changes (a logarithmic number
    of rounds, chains included). Edges and minima are written tables, so every join
    meets two plain shuffles, which Spark splits where a node has most of the edges.
    Nothing but a count and a checksum reaches the driver. No edges give no rows.
    """
    at = stage(_oriented(edges), "edges")
    before = None
    while (now := _fingerprint(at)) != before and now[0]:
        before = now
        both = at.union(at.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        at = stage(_oriented(large), "large")
        least = stage(at.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = at.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        at = stage(_oriented(small.union(least.select("a", F.col("m").alias("b")))), "small")
    roots = at.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node, without loops."""
    pair = edges.where(F.col("a") != F.col("b"))
    return pair.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
