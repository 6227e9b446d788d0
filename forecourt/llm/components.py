"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.session import materialise


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are all linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    rest = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Columns node, component for the linked nodes of ``edges`` (a, b: long).

    The component is its smallest node. Links of a node to itself, repeated links and links
    with a null end count for nothing; without links the result is empty. Every step is a
    written table, so a lost executor costs at most one step. The links are replaced until a
    step changes nothing, which is when every node points at its component.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = materialise(pairs.where("a <> b and isnotnull(a) and isnotnull(b)").distinct(), "links")
    mark = None
    while True:
        row = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == tuple(row) or row[0] == 0:
            break
        mark = tuple(row)
        now = materialise(_small(_large(now)), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
