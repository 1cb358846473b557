"""Connected components of links held in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import stored


def _print_of(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node of `edges` (a, b: bigint) with the smallest node it reaches.

    Large-star and small-star steps in turn, until the links no longer change; every step is a sum by
    node and a join, so that a node with very many links is summed before the shuffle and its join is
    split by Spark. The links after each pair of steps are written to the shared folder.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    seen = None
    while True:
        edges = stored(edges, "edges", small=True)
        now = _print_of(edges)
        if now in (seen, (0, None)):
            break
        seen = now
        both = edges.union(edges.select("b", "a"))
        lowest = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, both.a == lowest.u).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        lowest = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(lowest, large.a == lowest.u).where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = small.union(lowest.select("u", "m")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select("b", "b").distinct())
