"""Many prefixes against many texts, without comparing every pair.

``counts_by_prefix`` cuts each text at the lengths of the list, which suits lists of
few lengths.  ``sums_by_prefix`` answers lists of any lengths as sums over a sorted
layout.  In the order of bytes, the texts that start with a prefix are those from the prefix
up to the prefix followed by a byte that no text has.  So a prefix is two points, and
the rows under it are those between them.  The points cut all texts into gaps; each
text is counted in its one gap, and running sums over the gaps answer every prefix.
A row is looked at once, however many prefixes or lengths of prefixes there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ranges

# Blocks of points: their first points are one array, known to every task.
BLOCKS = 1023
BEYOND = b"\xff"


def _bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def _points(listed: DataFrame) -> DataFrame:
    """(prefix, sign, point): where each prefix begins (-1) and where it ends (1)."""
    start = _bytes(F.col("prefix"))
    ends = F.array(
        F.struct(F.lit(-1).alias("sign"), start.alias("point")),
        F.struct(F.lit(1).alias("sign"), F.concat(start, F.lit(BEYOND)).alias("point")),
    )
    return listed.withColumn("_end", F.explode(ends)).select("prefix", "_end.sign", "_end.point")


def sums_by_prefix(df: DataFrame, column: str, prefixes: DataFrame, size: str | None = None) -> DataFrame:
    """(prefix, n, bytes): rows under each listed prefix and the sum of their ``size``, 0 included.

    Without ``size`` there are no bytes.  NULL texts are under no prefix, NULL
    prefixes are left out, and a repeated prefix is one.

    Up to 1,023 points, drawn by a hash of the point, begin the blocks of points; a
    text finds its block by binary search among them, and its gap by another among
    the points of its block.  Blocks are joined by their number; Spark broadcasts
    them if they are small, and splits a hot one otherwise.  Rows are combined per
    gap before they are shuffled.
    """
    listed = prefixes.select("prefix").filter(F.col("prefix").isNotNull()).distinct()
    points = _points(listed)
    distinct = points.select("point").distinct()

    drawn = distinct.orderBy(F.xxhash64("point"), "point").limit(BLOCKS).agg(F.sort_array(F.collect_list("point")).alias("starts"))
    starts = drawn.scalar()

    def with_block(rows: DataFrame, text: str) -> DataFrame:
        found = rows.withColumn("_starts", starts)
        return found.withColumn("_block", ranges.place(F.col("_starts"), ranges.halvings(BLOCKS), F.col(text))).drop("_starts")

    blocks = with_block(distinct, "point").groupBy("_block").agg(F.sort_array(F.collect_list("point")).alias("_points"))
    blocks = blocks.withColumn("_steps", ranges.halvings(F.size("_points")))

    # Texts that agree in as many characters as the longest prefix has are counted together.
    longest = listed.agg(F.max(F.length("prefix"))).scalar()
    amount = F.col(size) if size else F.lit(None)
    rows = df.select(F.substr(F.col(column), F.lit(1), longest).alias("_cut"), amount.cast("bigint").alias("_size"))
    rows = rows.groupBy("_cut").agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_bytes"))
    rows = rows.select(_bytes(F.col("_cut")).alias("_text"), "_n", "_bytes").filter("_text is not null")
    # A block without points lies before the first point.
    placed = with_block(rows, "_text").join(blocks, "_block").select("_block", ranges.place(F.col("_points"), F.col("_steps"), F.col("_text")).alias("_gap"), "_n", "_bytes")
    gaps = placed.groupBy("_block", "_gap").agg(F.sum("_n").alias("_n"), F.sum("_bytes").alias("_bytes"))

    # Points of a block with the sums of the gaps before them, then of the blocks before.
    at = blocks.select("_block", F.posexplode("_points").alias("_gap", "point"))
    last = blocks.select("_block", F.size("_points").alias("_gap"), F.lit(None).cast("binary").alias("point"))
    filled = at.unionByName(last).join(gaps, ["_block", "_gap"], "left")
    within = Window.partitionBy("_block").orderBy("_gap")
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = filled.groupBy("_block").agg(F.sum("_n").alias("_n"), F.sum("_bytes").alias("_bytes"))
    offsets = totals.select("_block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("_n", "_bytes")])
    running = filled.select("_block", "point", *[F.coalesce(F.sum(c).over(within), F.lit(0)).alias(c) for c in ("_n", "_bytes")])
    ranks = running.filter("point is not null").join(offsets, "_block")
    ranks = ranks.select("point", (F.col("_n") + F.col("_n_before")).alias("_n"), (F.col("_bytes") + F.col("_bytes_before")).alias("_bytes"))

    ended = points.join(ranks, "point").groupBy("prefix")
    sums = [F.sum(F.col("sign") * F.col("_n")).alias("n"), F.sum(F.col("sign") * F.col("_bytes")).alias("bytes")]
    return ended.agg(*sums[: 2 if size else 1])


def cut_at_lengths(df: DataFrame, column: str, prefixes: DataFrame, into: str = "prefix") -> DataFrame:
    """One row per row of ``df`` and distinct prefix length that fits in its text.

    The lengths come from a scalar subquery.  Their number is bounded by the
    longest text, not by the number of prefixes.
    """
    lengths = prefixes.agg(F.collect_set(F.length("prefix"))).scalar()
    cut = df.withColumn("_length", F.explode(lengths)).filter(F.col("_length") <= F.length(column))
    return cut.withColumn(into, F.substr(F.col(column), F.lit(1), F.col("_length"))).drop("_length")


def counts_by_prefix(df: DataFrame, column: str, prefixes: DataFrame) -> DataFrame:
    """Number of rows under each listed prefix, 0 included.

    Cuts outside the range of the list go first; the others are counted before
    they meet it, which leaves one row per task and cut, however hot a prefix is.
    """
    listed = prefixes.select("prefix").filter(F.col("prefix").isNotNull())
    cut = cut_at_lengths(df.select(column), column, listed).select("prefix")
    ends = listed.agg(F.struct(F.min("prefix").alias("first"), F.max("prefix").alias("last"))).scalar()
    cut = cut.filter(F.col("prefix").between(ends["first"], ends["last"]))
    counts = cut.groupBy("prefix").agg(F.count("*").alias("n"))
    return listed.distinct().join(counts, "prefix", "left").select("prefix", F.coalesce("n", F.lit(0)).alias("n"))
