"""Mixing sources to target weights by temperature, with built-in Spark expressions only.

Token shares raised to an exponent and normalised are the weights.  The exponent is
bisected: the largest one in [0, 1] whose weights have the target entropy, or, where
that would repeat some source more often than allowed, the smallest one that keeps
the limit.  The weights times a token budget are then realised: every source's
documents stand in a permuted order of blocks; whole rounds give every document a
copy, and the last round ends in the block where the budget is met.

Sums over sources and blocks pass the driver one row at a time; nothing else does.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_SPACE, others, saved


def word_count(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(f"[^{ASCII_SPACE}]+")).cast("long")


def _place(id_column: str, text: str, seed: int) -> Column:
    """Where a row stands in its source's permutation: a fraction of 1 with 52 bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_column), F.col(text)), 12) / F.lit(float(1 << 52))


def _entropy_and_repeats(tokens: DataFrame, exponent: float, budget: float, total: float) -> tuple[float, float]:
    power = F.pow(F.col("tokens") / total, F.lit(exponent))
    weighted = tokens.select("tokens", power.alias("p"))
    row = weighted.agg(
        F.sum("p").alias("z"), F.sum(F.col("p") * F.ln("p")).alias("plogp"), F.max(F.col("p") / F.col("tokens")).alias("most")
    ).first()
    return math.log(row["z"]) - row["plogp"] / row["z"], row["most"] / row["z"] * budget


def find_exponent(tokens: DataFrame, budget: float, entropy: float, repeats: float, steps: int = 24) -> float:
    """The exponent for sources (source, tokens > 0); ``entropy`` is a share of the largest possible one."""
    row = tokens.agg(F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("sources")).first()
    if not row["sources"] or row["sources"] == 1:
        return 1.0
    total, target = float(row["total"]), entropy * math.log(row["sources"])

    def bisect(low: float, high: float, holds_low) -> float:
        for _ in range(steps):
            middle = (low + high) / 2
            low, high = (middle, high) if holds_low(middle) else (low, middle)
        return low

    def measured(a: float) -> tuple[float, float]:
        return _entropy_and_repeats(tokens, a, budget, total)

    # Entropy falls with the exponent, and so do the repeats of the smallest source.
    exponent = 1.0 if measured(1.0)[0] >= target else bisect(0.0, 1.0, lambda a: measured(a)[0] >= target)
    if measured(exponent)[1] > repeats:
        exponent = 1.0 if measured(1.0)[1] > repeats else 1.0 - bisect(0.0, 1.0 - exponent, lambda b: measured(1.0 - b)[1] <= repeats)
    return exponent


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    budget: float = 1.0,
    entropy: float = 0.9,
    repeats: float = 2.0,
    block_tokens: int = 200_000,
    seed: int = 17,
) -> DataFrame:
    """``docs`` realised at the mixed weights: a row per copy, with ``copy`` (int, from 0), ``weight`` and ``place``.

    ``budget`` is a multiple of all words of ``docs``, ``entropy`` a share of
    ln(number of sources), ``repeats`` the most rounds of any source, which the
    entropy gives way to.  A source's last round takes whole blocks of its permutation
    while they fit, and rows of the next one while they fit; so it ends at most one
    row short of its target.  A NULL source is a source of its own.  Rows without
    words belong to a block like others and cost nothing; a source without any words
    keeps each row once.  Equal rows stand at one place and are taken together or
    not at all.  Columns with the names of the added ones, in any case, are replaced.
    An empty table gives an empty one.
    """
    added = ["copy", "weight", "place"]
    columns = others(docs, *added)
    # One scan for all statistics: words and place of every row, without its text.
    place = _place(id_column, text, seed)
    measured = saved(docs.select(F.col(f"`{source}`").alias("s"), word_count(text).alias("w"), place.alias("place")), "mix-rows")
    tokens = saved(measured.groupBy("s").agg(F.sum("w").alias("tokens")), "mix-sources")
    heard = tokens.filter("tokens > 0")
    total = heard.agg(F.sum("tokens")).first()[0] or 0
    exponent = find_exponent(heard, budget * total, entropy, repeats)

    power = F.pow(F.col("tokens") / F.lit(float(max(total, 1))), F.lit(exponent))
    z = heard.agg(F.sum(power)).first()[0] or 1.0
    plan = tokens.select(
        "s", "tokens", F.when(F.col("tokens") > 0, power / F.lit(z)).otherwise(F.lit(0.0)).alias("weight")
    )
    target = F.least(F.col("weight") * F.lit(budget * total), F.col("tokens") * F.lit(float(repeats)))
    plan = plan.withColumn("target", target)
    plan = plan.withColumn("rounds", F.when(F.col("tokens") > 0, F.floor(F.col("target") / F.col("tokens") + 1e-9)).otherwise(F.lit(1)).cast("int"))
    plan = plan.withColumn("left", F.when(F.col("tokens") > 0, F.greatest(F.lit(0.0), F.col("target") - F.col("rounds") * F.col("tokens"))).otherwise(F.lit(0.0)))
    plan = plan.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(block_tokens))))
    plan = saved(plan, "mix-plan")

    # The last round: blocks in order while they fit, then the rows of one block.
    same = F.col("m.s").eqNullSafe(F.col("p.s"))
    rows = measured.alias("m").join(plan.alias("p"), same).select("p.s", "w", "place", "left", F.floor(F.col("place") * F.col("blocks")).alias("block"))
    blocks = rows.groupBy("s", "block").agg(F.sum("w").alias("bw"), F.first("left").alias("left"))
    order = Window.partitionBy("s").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    ends = blocks.withColumn("end", F.sum("bw").over(order)).filter(F.col("end") > F.col("left"))
    cut = ends.groupBy("s").agg(F.min(F.struct("block", "end", "bw", "left")).alias("c"))
    cut = cut.select("s", "c.block", (F.col("c.left") - F.col("c.end") + F.col("c.bw")).alias("room"))
    cut = saved(cut, "mix-cuts")
    inside = rows.alias("r").join(cut.alias("c"), F.col("r.s").eqNullSafe(F.col("c.s")) & (F.col("r.block") == F.col("c.block")))
    inside = inside.groupBy(F.col("r.s").alias("s"), "place").agg(F.sum("w").alias("w"), F.first("room").alias("room"))
    order = Window.partitionBy("s").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    beyond = inside.withColumn("end", F.sum("w").over(order)).filter(F.col("end") > F.col("room"))
    limit = beyond.groupBy("s").agg(F.min("place").alias("limit"))

    # A source whose last round holds everything left has no limit.
    final = plan.alias("p").join(limit.alias("l"), F.col("p.s").eqNullSafe(F.col("l.s")), "left")
    final = saved(final.select("p.s", "weight", "rounds", F.when(F.col("left") > 0, F.coalesce("limit", F.lit(1.0))).otherwise(F.lit(0.0)).alias("limit")), "mix-limits")
    taken = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("d"), F.col(f"`{source}`").alias("ds"), place.alias("place"))
    taken = taken.join(final.alias("f"), F.col("ds").eqNullSafe(F.col("f.s")))
    copies = F.col("rounds") + F.when(F.col("place") < F.col("limit"), 1).otherwise(0)
    taken = taken.withColumn("copies", copies).filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    return taken.select(*[F.col(f"d.`{c}`") for c in columns], "copy", "weight", "place")

