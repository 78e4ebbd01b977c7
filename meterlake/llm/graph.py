"""Connected components of an undirected graph of 64-bit node numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import drop, materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: a node's larger neighbours (or itself and its smaller
    ones) are linked to the least of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.filter("b < a")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "u")
    out = both.join(least, F.col("a") == F.col("u"))
    moved = out.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) if large else (
        out.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u"), F.col("m"))))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node that it reaches) of every node of ``edges``
    (columns a, b; self-links and repeats are allowed).

    Alternating large and small stars: the rounds grow with the logarithm of the
    graph, each is a join on the node whose result is written out, and no link
    leaves the executors.
    """
    edges = materialise(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
                        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    while True:
        edges, last = materialise(_star(_star(edges, True), False), "links"), edges
        drop(last)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    # a star of every component: each node points at the least one
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select("b", F.col("b")).distinct())
