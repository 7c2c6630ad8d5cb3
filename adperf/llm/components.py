"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import stored


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b), the component named by its smallest node.

    Each round links every node's larger neighbours to its smallest one, then its smaller neighbours and itself; the edges
    become stars around the smallest nodes in a number of rounds that grows with the logarithm of a component's
    diameter. All steps are grouped minima (partial ones first) and equi-joins; each round is written to the shared folder.
    A hub's edges are one row for each neighbour, which a skewed join can split.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, name)
    seen = _signature(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), name)
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
