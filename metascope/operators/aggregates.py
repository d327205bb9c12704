"""Totals and counts.  All are combined before the shuffle, so hot keys cost nothing extra."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from . import filters


def total_size(objects: DataFrame) -> DataFrame:
    """Bytes of all objects, in one row; 0 if there are none."""
    return objects.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("total_bytes"))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def by_type_and_status(jobs: DataFrame) -> DataFrame:
    """Jobs and average training seconds per type and status.

    Types without training seconds have a NULL average.
    """
    return jobs.groupBy("type", "status").agg(
        F.count("*").alias("n"), F.avg("training_time_seconds").alias("avg_training_seconds")
    )


def by_first_token(df: DataFrame, column: str = "name", sep: str = "-") -> DataFrame:
    """Rows per first token of a delimited name."""
    return df.groupBy(C.first_token(column, sep).alias("token")).agg(F.count("*").alias("n"))


def by_service(resources: DataFrame) -> DataFrame:
    return resources.groupBy("service").agg(F.count("*").alias("n"))


def tag_audit(resources: DataFrame, tag_rows: DataFrame, key: str = "resource_id") -> DataFrame:
    """Resources, and those of them without any tag, per service.

    ``resources`` has service and ``key``.  A resource in the list twice is one;
    services whose resources all have tags are listed with 0.
    """
    listed = resources.select("service", key).distinct()
    tagged = tag_rows.select(F.col("resource_id").alias(key)).distinct().withColumn("_tagged", F.lit(1))
    marked = listed.join(tagged, key, "left")
    untagged = F.count(F.when(F.col("_tagged").isNull(), 1))
    return marked.groupBy("service").agg(F.count(F.lit(1)).alias("n"), untagged.alias("n_untagged"))


def instance_hours(jobs: DataFrame, instance_type: str, seconds: str = "training_time_seconds") -> DataFrame:
    """Hours that jobs ran on one instance type, in one row."""
    used = filters.equals(jobs, "instance_type", instance_type)
    total = F.coalesce(F.sum(seconds), F.lit(0))
    return used.agg(total.alias("total_seconds"), C.hours(total).alias("total_hours"))


def failures_per_machine(machines: DataFrame, failed: DataFrame, include_none: bool = False) -> DataFrame:
    """Failed executions per machine; machines with none only if ``include_none``.

    Counted per ARN first: the join then sees one row per machine, however
    many executions one of them has.
    """
    counts = failed.groupBy(F.col("machine_arn").alias("arn")).agg(F.count("*").alias("n"))
    joined = machines.select("arn", "name").join(counts, "arn", "left" if include_none else "inner")
    return joined.select("name", "arn", F.coalesce("n", F.lit(0)).alias("n"))


def run_summary(machines: DataFrame, plan: DataFrame) -> DataFrame:
    """One row: machines checked, failures found, and what became of them.

    A plan with outcomes is counted as run; one without is a dry run, in which
    all failures would be retried.
    """
    dry = "retry_started" not in plan.columns
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    retried = zero if dry else F.col("retry_started").cast("bigint")
    rows = machines.select(one.alias("machine"), zero.alias("failed"), zero.alias("retried")).unionAll(
        plan.select(zero, one, retried)
    )
    totals = rows.agg(
        *[
            F.coalesce(F.sum(column), zero).alias(name)
            for column, name in (("machine", "machines_checked"), ("failed", "failed_found"), ("retried", "retried"))
        ]
    )
    if dry:
        return totals.select("machines_checked", "failed_found", F.col("failed_found").alias("would_retry"))
    return totals.withColumn("failed_to_retry", F.col("failed_found") - F.col("retried"))


def tags_as_map(tag_rows: DataFrame) -> DataFrame:
    """One tag map per resource; of equal keys the highest ``seq`` wins.

    Equal keys are reduced before the shuffle by resource, so a map is built
    from distinct keys only.
    """
    last = tag_rows.groupBy("resource_id", "key").agg(F.max(F.struct("seq", "value")).alias("last"))
    return last.groupBy("resource_id").agg(
        F.map_from_entries(F.collect_list(F.struct("key", F.col("last.value").alias("value")))).alias("tags")
    )
