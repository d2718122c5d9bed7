"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.shared import written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of an edge.

    ``edges`` has columns ``a`` and ``b`` of one type, in any order; loops and nulls are
    left out. Every round moves rows no more than twice the edges, a node's neighbours
    are never gathered (only their minimum is), and a node that most edges share is split
    by adaptive execution, as each join has one row per node on its other side. Rounds grow
    with the logarithm of a component's size; each is written to the shared folder.
    """
    current = written(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _mark(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written, so that the join shuffles both sides and can split a node of most edges.
        least = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = written(large, "large-star")
        least = written(large.groupBy("a").agg(F.min("b").alias("low")), "least")
        joined = large.join(least, "a")
        small = joined.where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            least.select("a", F.col("low").alias("b")))
        current = written(small.distinct(), "small-star")
        now = _mark(current)
        if now == before:
            break
        before = now
    roots = current.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
