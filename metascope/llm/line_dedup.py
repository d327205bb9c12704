"""Line deduplication over levelled sorted runs of line hashes.

The documents' lines are counted once, by batch.  Each batch is merge-anti-joined
with the runs of lines already known to be frequent, and what is left becomes a
sorted run of its own.  When a level holds ``fanout`` runs they are compacted to
one run of the next level, and lines whose count has reached the limit move to the
frequent runs.  A last compaction decides the rest, so the result is exact.

A line is identified by 128 bits of its key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, LOWER, UPPER, others, packed, row_hash, saved

KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(ASCII_SPACE)), UPPER, LOWER)


def lines_of(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2")]


def count_lines(docs: DataFrame, text: str, batches: int, min_chars: int) -> DataFrame:
    """Documents per batch and line; a document counts once for each line that it has."""
    keys = F.array_distinct(F.transform(lines_of(text), line_key))
    lines = docs.select(F.pmod(F.xxhash64(text), F.lit(batches)).cast("int").alias("batch"), F.explode(keys).alias("key"))
    lines = lines.filter(F.length("key") >= min_chars)
    return lines.select("batch", *_hashes(F.col("key"))).groupBy("batch", *KEY).agg(F.count(F.lit(1)).alias("n"))


def _merged(runs: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, runs).groupBy(*KEY).agg(F.sum("n").alias("n"))


def frequent_lines(counts: DataFrame, batches: int, min_docs: int, fanout: int) -> DataFrame:
    """The lines (h1, h2) of at least ``min_docs`` documents, by levelled runs over the batches of ``counts``."""

    def run(df: DataFrame) -> DataFrame:
        return saved(df.sortWithinPartitions(*KEY), "line-run")

    levels: list[list[DataFrame]] = [[]]
    frequent: list[DataFrame] = []
    for batch in range(batches):
        fresh = counts.filter(F.col("batch") == batch).drop("batch")
        for known in frequent:
            fresh = fresh.join(known.hint("merge"), KEY, "left_anti")
        levels[0].append(run(fresh))
        level = 0
        while len(levels[level]) >= fanout:
            if level + 1 == len(levels):
                levels.append([])
            merged = run(_merged(levels[level]))
            frequent.append(run(merged.filter(F.col("n") >= min_docs).select(*KEY)))
            levels[level] = []
            levels[level + 1].append(merged.filter(F.col("n") < min_docs))
            level += 1
    rest = [df for level in levels for df in level]
    if rest:
        frequent.append(_merged(rest).filter(F.col("n") >= min_docs).select(*KEY))
    return reduce(DataFrame.unionByName, frequent).distinct()


def dedup_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    batches: int = 4,
    fanout: int = 2,
) -> DataFrame:
    """``docs`` without the lines found in at least ``min_docs`` documents.

    ``text`` holds the other lines, joined by newlines; ``n_lines`` and
    ``n_dropped`` (long) are added, and take the place of columns of that name in any case.
    Each row is a document, also if rows repeat or the id is NULL.  NULL or empty
    text is one empty line, kept as an empty text.  Keys shorter than
    ``min_chars`` are never dropped.  An empty table gives an empty table.
    """
    counts = saved(count_lines(docs, text, batches, min_chars), "line-counts", "batch")
    frequent = frequent_lines(counts, batches, min_docs, fanout)

    # Rows are told apart by 128 bits of id and text: equal rows lose the same lines.
    row = [row_hash(id_column, text, seed=1).alias("r1"), row_hash(id_column, text, seed=2).alias("r2")]
    at = docs.select(*row, F.posexplode(F.transform(lines_of(text), line_key)).alias("pos", "key"))
    at = at.filter(F.length("key") >= min_chars).select("r1", "r2", "pos", *_hashes(F.col("key")))
    hits = at.join(frequent, KEY, "left_semi").groupBy("r1", "r2").agg(F.sort_array(F.collect_set("pos")).alias("drop"))
    joined = docs.select(packed(docs.columns).alias("doc"), *row).join(hits, ["r1", "r2"], "left")

    # The lines between one dropped line and the next are slices.
    lines = F.split(F.coalesce(F.col(f"doc.{text}"), F.lit("")), "\n")
    joined = joined.select("doc", "drop", lines.alias("lines"))
    ends = F.concat(F.array(F.lit(-1)), F.col("drop"), F.array(F.size("lines")))
    joined = joined.select("doc", "drop", "lines", ends.alias("ends"))
    # An index past the last gap is never made: there is one gap more than dropped lines.
    gaps = F.transform(
        F.sequence(F.lit(0), F.size("drop")),
        lambda i: F.slice("lines", F.col("ends")[i] + 2, F.col("ends")[i + 1] - F.col("ends")[i] - 1),
    )
    kept = F.when(F.col("drop").isNull(), F.coalesce(F.col(f"doc.{text}"), F.lit(""))).otherwise(F.array_join(F.flatten(gaps), "\n"))
    new = {
        text: kept,
        "n_lines": F.size("lines").cast("long"),
        "n_dropped": F.when(F.col("drop").isNull(), F.lit(0)).otherwise(F.size("drop")).cast("long"),
    }
    made = joined.select("doc", F.struct(*[value.alias(name) for name, value in new.items()]).alias("made"))
    return made.select(*[F.col(f"doc.`{c}`") for c in others(docs, *new)], "made.*")
