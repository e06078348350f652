"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_engine.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b); the root is the smallest node.

    Large-star and small-star steps in turn: the neighbours of a node are linked to the
    smallest of them, first the larger ones, then the smaller ones. Only minima and joins
    are used, so that a node may have any number of neighbours. Each round is stored; the
    driver gets a count and a checksum. Ends when a round changes nothing.
    """
    a, b = F.col("a"), F.col("b")
    now = stored(
        edges.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(),
        "edges",
    )
    before = None
    while (mark := _mark(now)) != before:
        before = mark
        both = now.unionByName(now.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter(b > a).join(least, "a").select(b.alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(b.alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        now = stored(small.filter(a != b).distinct(), "edges")
    return now.select(a.alias("node"), b.alias("root")).unionByName(
        now.select(b.alias("node"), b.alias("root")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    checksum = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), checksum).first())
