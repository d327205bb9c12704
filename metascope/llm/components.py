"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the component's smallest node.

    Each step replaces links by links to the smallest neighbour, so their number
    never grows; every round is written to the shared folder.  A node with very
    many links is split by Spark's handling of skewed joins.
    """
    edges = saved(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "links")
    mark = _fingerprint(edges)
    while mark[0]:
        both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u")
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        edges = saved(moved.filter("u > v").distinct(), "links")
        before, mark = mark, _fingerprint(edges)
        if mark == before:
            break
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.union(edges.select(F.col("v"), F.col("v")).distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
