"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node
    of its component. Alternating large-star and small-star rounds: each round is a
    pair of grouped minima joined back, and rounds grow with the logarithm of a
    component's diameter. Every round is written to the shared folder and replaces the
    copy of the round before; only two numbers (edge count and checksum) come to the driver."""
    a, b = F.greatest("a", "b"), F.least("a", "b")
    stars = written(edges.where("a <> b").select(a.alias("a"), b.alias("b")).distinct(), "edges")
    mark = _mark(stars)
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = linked.unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        stars = written(small, "stars", retire=stars)
        new = _mark(stars)
        if new == mark:
            break
        mark = new
    return (stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
