"""Lookups as joins: details, latest run, tags, ids, a gate.

The looked-up side is reduced to one row per key before it is shuffled, so no
row is multiplied and only the looking side can be hot.
No side is forced to broadcast: Spark does that below its size threshold, and
splits a hot key of a sort-merge join otherwise (see ``session``).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import literals as L
from . import filters

MISS_POLICIES = ("null", "sentinel", "error", "drop")

# When a detail landed; the newest counts.
LANDED = "landed_at"


def enrich(
    df: DataFrame,
    details: DataFrame,
    key: str,
    columns: dict[str, Column],
    miss: str = "null",
    sentinel: tuple[str, str] | None = None,
    error_text: str = "details not found",
) -> DataFrame:
    """Adds ``columns``, computed over ``details``, by a join on ``key``.

    Of several details of a key the one that landed last counts, by ``landed_at``
    if the details have it (``read_details`` adds it); of those that landed
    together, and without that column, the one with the greatest columns.

    ``miss`` says what a row without details gets: NULLs (``null``), a fixed
    text in one column (``sentinel``, a pair of column and text), a text in an
    ``error`` column (``error``), or removal (``drop``).
    """
    if miss not in MISS_POLICIES:
        raise ValueError(f"miss must be one of {MISS_POLICIES}: {miss!r}")
    landed = [LANDED] if LANDED in details.columns else []
    right = one_per_key(details.select(key, *landed, *[c.alias(name) for name, c in columns.items()]), key)
    right = right.drop(*landed).withColumn("_found", F.lit(True))
    if miss == "drop":
        return df.join(right, key, "inner").drop("_found")
    joined = df.join(right, key, "left")
    absent = F.col("_found").isNull()
    if miss == "sentinel":
        column, text = sentinel
        joined = joined.withColumn(column, F.when(absent, F.lit(text)).otherwise(F.col(column)))
    if miss == "error":
        joined = joined.withColumn("error", F.when(absent, F.lit(error_text)))
    return joined.drop("_found")


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the greatest; equal details that landed twice are one."""
    others = [c for c in df.columns if c != key]
    if not others:
        return df.distinct()
    return df.groupBy(key).agg(F.max(F.struct(*others)).alias("_row")).select(key, "_row.*")


def latest_runs(runs: DataFrame) -> DataFrame:
    """The last run of each job: by start, missing starts first, then by id.

    In two steps: the last start is a fixed-width ``max``, a hash aggregate that is
    combined before the shuffle; then the runs with that start are looked up, and
    the few that share it are ranked by id.  No step sorts all runs.
    """
    last = runs.groupBy("job_name").agg(F.max("started_on").alias("_start")).withColumnRenamed("job_name", "_job")
    at_last = F.col("job_name").eqNullSafe(F.col("_job")) & F.col("started_on").eqNullSafe(F.col("_start"))
    newest = runs.join(last.hint("shuffle_hash"), at_last, "left_semi")
    order = Window.partitionBy("job_name").orderBy(*[F.desc(c) for c in ("id", "status", "execution_time")])
    ranked = newest.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1")
    # One row a job is left; grouping them tells Spark so, which then drops a lookup that nobody reads.
    one = ranked.groupBy("job_name").agg(F.collect_list(F.struct("id", "status", "started_on", "execution_time"))[0].alias("last"))
    return one.select(
        "job_name",
        F.col("last.id").alias("last_run_id"),
        F.col("last.status").alias("last_run_status"),
        F.col("last.started_on").alias("last_run_time"),
        F.coalesce("last.execution_time", F.lit(0)).alias("last_run_duration"),
    )


def jobs_with_last_run(
    jobs: DataFrame, runs: DataFrame, status: str | None = None, keep_never_run: bool = False
) -> DataFrame:
    """Jobs with the columns of their last run, optionally only those that ended in ``status``.

    Under a status, a job that never ran is dropped unless ``keep_never_run``.
    """
    last = latest_runs(runs).drop("last_run_id").withColumnRenamed("job_name", "name")
    joined = jobs.join(last, "name", "left")
    if not status:
        return joined
    hit = F.col("last_run_status") == status
    if keep_never_run:
        # An existing run with no status is not a never-run job: its duration is set.
        hit = F.coalesce(hit, F.lit(False)) | F.col("last_run_duration").isNull()
    return joined.filter(hit)


def having_tags(df: DataFrame, key: str, tag_rows: DataFrame, wanted, trim: bool = True) -> DataFrame:
    """Rows of ``df`` whose tag rows hold every wanted pair; no valid pair, no filter.

    For each wanted key the row with the highest ``seq`` counts.  Its number
    and whether its value fits are packed into one integer, so the aggregate
    stays a hash aggregate that is combined before the shuffle.
    """
    pairs = list(L.tag_pairs(wanted, trim).items())
    if not pairs:
        return df
    rows = tag_rows.filter(F.col("key").isin([k for k, _ in pairs]))
    last = [
        F.max(
            F.when(
                F.col("key") == k,
                F.coalesce("seq", F.lit(0)).cast("bigint") * 2 + F.col("value").eqNullSafe(F.lit(v)).cast("bigint"),
            )
        ).alias(f"_tag{i}")
        for i, (k, v) in enumerate(pairs)
    ]
    grouped = rows.groupBy("resource_id").agg(*last)
    for i in range(len(pairs)):
        grouped = grouped.filter(F.pmod(F.col(f"_tag{i}"), F.lit(2)) == 1)
    return df.join(grouped.select(F.col("resource_id").alias(key)), key, "left_semi")


def with_details(ids: DataFrame, details: DataFrame, key: str) -> DataFrame:
    """Details of the listed ids; ids without details are dropped, and repeated ids don't repeat them."""
    return details.join(ids.select(key), key, "left_semi")


# As many values an IN may have to reach the row groups of a Parquet scan one by one.
PUSHED_IN = 10


def by_ids(details: DataFrame, key: str, ids: Iterable[str]) -> DataFrame:
    """Details of a short list of ids, as a filter that reaches the scan.

    Ids go to the scan in tens, so that Parquet's bloom filters (``find_by`` of
    ``save_table``) can tell the row groups that hold none of them.  For a list
    that is data, use ``with_details``.
    """
    listed = sorted(set(ids))
    if not listed:
        return details.filter(F.lit(False))
    tens = [F.col(key).isin(listed[i : i + PUSHED_IN]) for i in range(0, len(listed), PUSHED_IN)]
    return details.filter(reduce(or_, tens))


def machines_with_failures(machines: DataFrame, failed: DataFrame, name_prefix: str = "") -> DataFrame:
    """Each machine under a prefix with each of its failed executions."""
    few = filters.prefix(machines, "name", name_prefix).select(F.col("name").alias("machine_name"), "arn")
    return failed.join(few, failed["machine_arn"] == few["arn"], "inner").drop("arn")


def untagged(df: DataFrame, key: str, tag_rows: DataFrame) -> DataFrame:
    """Rows with no tag row at all.

    Tag rows are reduced to one per resource before they are shuffled.
    """
    tagged = tag_rows.select(F.col("resource_id").alias(key)).distinct()
    return df.join(tagged, key, "left_anti")


def gated_tables(
    tables: DataFrame,
    jobs: DataFrame,
    runs: DataFrame,
    job_prefix: str,
    table_prefix: str,
    status: str = "SUCCEEDED",
) -> DataFrame:
    """Tables under a prefix, but only if the first job under another prefix last ended well.

    The first job is found by name; only its runs are read.  Both answers are
    scalar subqueries, so there is no join and nothing passes the caller.
    """
    first_job = filters.prefix(jobs, "name", job_prefix).agg(F.min("name"))
    own_runs = runs.filter(F.col("job_name") == first_job.scalar())
    last_status = own_runs.agg(F.max(F.struct("started_on", "id", "status")).alias("last")).select("last.status")
    return filters.prefix(tables, "table", table_prefix).filter(last_status.scalar() == status)
