"""Action plans.  They say what should be done; doing it is left to the reader of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.literals import Instant, days_before
from ..operators import filters, lookups
from ..sources import listings

# Fixed value: the text of a rerun command; the placeholders are ARN and input.
RERUN_COMMAND = """aws stepfunctions start-execution \\
  --state-machine-arn "%s" \\
  --input '%s'"""


def retry_plan(
    machines: DataFrame,
    executions: DataFrame,
    inputs: DataFrame | None,
    prefix: str = "",
    days: int = 7,
    *,
    as_of: Instant,
) -> DataFrame:
    """Failed executions of the machines under a prefix, each of which would be retried.

    Inputs are looked up last, for the executions that are left; one that has not
    landed is NULL, and ``input_found`` says so.  Without ``inputs`` the plan has
    the same rows.
    """
    failed = listings.recent_failures(executions, days=days, as_of=as_of)
    found = lookups.machines_with_failures(machines, failed, prefix)
    if inputs is not None:
        found = listings.with_inputs(found, inputs)
    return found.select(
        F.col("execution_arn").alias("original_execution"),
        F.lit(True).alias("would_retry"),
        *(["input", "input_found"] if inputs is not None else []),
        "name",
        "machine_name",
        "machine_arn",
    )


def with_retry_names(plan: DataFrame, as_of: Instant) -> DataFrame:
    """The plan with the name each retry would run under."""
    stamp = F.date_format(C.at(as_of), "yyyyMMdd-HHmmss")
    return plan.withColumn("retry_name", F.concat(F.lit("retry-"), "name", F.lit("-"), stamp))


def rerun_commands(plan: DataFrame, execution: str = "original_execution") -> DataFrame:
    """A shell command per planned retry, or per failed execution.

    ``execution`` is the column with the ARN: ``execution_arn`` for a listing of
    failed executions.

    JSON input is normalised; other input is passed on as it is, and flagged.
    A single quote in the input is escaped for the shell.  An execution whose
    input has not landed gets no command.
    """
    quoted = F.replace(C.json_text("input"), F.lit("'"), F.lit("'\\''"))
    found = F.col("input_found") if "input_found" in plan.columns else F.lit(True)
    return plan.select(
        F.col(execution).alias("original_execution"),
        C.is_json("input").alias("input_is_json"),
        F.when(found, F.format_string(RERUN_COMMAND, "machine_arn", quoted)).alias("command"),
    )


def retry_outcomes(plan: DataFrame, attempts: DataFrame) -> DataFrame:
    """The plan with what its landed attempts came to; of several attempts one that started counts, else the last error."""
    columns = ["original_execution", "retry_started", "error"]
    columns += ["retry_execution"] if "retry_execution" in attempts.columns else []
    found = lookups.one_per_key(attempts.select(*columns), "original_execution").withColumn("attempted", F.lit(True))
    started = F.coalesce("retry_started", F.lit(False))
    return plan.join(found, "original_execution", "left").select(
        *plan.columns,
        F.coalesce("attempted", F.lit(False)).alias("attempted"),
        *([F.col("retry_execution")] if "retry_execution" in attempts.columns else []),
        started.alias("retry_started"),
        F.when(~started, F.coalesce("error", F.lit("Unknown error"))).alias("error"),
    )


def empty_objects(objects: DataFrame) -> DataFrame:
    """Objects without content, to be deleted."""
    return filters.in_range(objects, "size", high="0B")


def archive_candidates(
    objects: DataFrame,
    prefix: str = "",
    older_than: Instant = "90 days ago",
    *,
    as_of: Instant,
    archive: str = "archive",
    storage_class: str = "GLACIER",
) -> DataFrame:
    """Old objects with the place they would be archived to: a folder of the archive for each bucket."""
    old = filters.in_period(filters.prefix(objects, "key", prefix), "last_modified", None, older_than, as_of)
    return old.select(
        F.concat(F.lit("s3://"), "bucket", F.lit("/"), "key").alias("source"),
        F.concat(F.lit(f"s3://{archive}/"), "bucket", F.lit("/"), "key").alias("target"),
        F.lit(storage_class).alias("target_class"),
    )


def stale_failed_jobs(jobs: DataFrame, days: int = 7, *, as_of: Instant) -> DataFrame:
    """Jobs whose last run failed more than ``days`` days ago."""
    failed = filters.equals(jobs, "last_run_status", "FAILED")
    return failed.filter(F.col("last_run_time") < F.lit(days_before(as_of, days))).select("name")


def restart_candidates(jobs: DataFrame, runs: DataFrame, prefix: str = "") -> DataFrame:
    """Names of the jobs under a prefix whose last run failed."""
    few = filters.prefix(jobs, "name", prefix).select("name")
    return lookups.jobs_with_last_run(few, runs, "FAILED").select("name")
