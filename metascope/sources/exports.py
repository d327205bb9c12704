"""The same entities in their export form: plain columns, nothing defaulted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.literals import Instant
from ..operators import filters, lookups


def objects(raw: DataFrame, bucket: str | None = None, prefix: str = "") -> DataFrame:
    df = filters.prefix(filters.equals(raw, "bucket", bucket), "Key", prefix)
    return df.select(
        F.col("Key").alias("key"),
        F.col("LastModified").alias("last_modified"),
        F.col("Size").alias("size"),
        F.col("StorageClass").alias("storage_class"),
    )


def catalog_metadata(raw: DataFrame, database: str | None = None, catalog: str | None = None) -> DataFrame:
    """Table metadata; ``catalog`` and ``database`` filter the columns of that name."""
    df = filters.equals(filters.equals(raw, "catalog", catalog), "database", database)
    return df.select(
        F.col("Name").alias("name"),
        F.col("CreateTime").alias("create_time"),
        F.col("LastAccessTime").alias("last_access_time"),
        F.col("TableType").alias("table_type"),
    )


def jobs(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("Name").alias("name"),
        F.col("Role").alias("role"),
        F.col("CreatedOn").alias("created_on"),
        F.col("LastModifiedOn").alias("last_modified_on"),
        F.col("MaxCapacity").alias("max_capacity"),
    )


def job_runs(raw: DataFrame, job_name: str, days: int = 7, *, as_of: Instant) -> DataFrame:
    """Runs of one job in the last ``days`` days; a run with no start is kept."""
    df = filters.since_or_missing(filters.equals(raw, "JobName", job_name), "StartedOn", days, as_of)
    return df.select(
        F.lit(job_name).alias("job_name"),
        F.col("Id").alias("id"),
        F.col("JobRunState").alias("status"),
        F.col("StartedOn").alias("started_on"),
        F.col("CompletedOn").alias("completed_on"),
    )


def query_errors(
    ids: DataFrame, details: DataFrame, workgroup: str = "primary", days: int = 7, *, as_of: Instant
) -> DataFrame:
    """Failed queries of a workgroup in the last ``days`` days.

    ``ids`` lists the workgroup's queries (``workgroup``, ``QueryExecutionId``);
    ``details`` describes them.  Both sides are filtered before they are joined.
    """
    listed = filters.equals(ids, "workgroup", workgroup).select("QueryExecutionId")
    own = filters.equals(details, "WorkGroup", workgroup)
    failed = filters.failed_since(own, "Status.State", "Status.SubmissionDateTime", days, as_of)
    return lookups.with_details(listed, failed, "QueryExecutionId").select(
        F.col("QueryExecutionId").alias("query_id"),
        F.col("WorkGroup").alias("workgroup"),
        F.col("Status.SubmissionDateTime").alias("submission_time"),
        F.col("Status.StateChangeReason").alias("failure_reason"),
    )


def pipeline_executions(raw: DataFrame, pipeline_name: str, days: int = 7, *, as_of: Instant) -> DataFrame:
    """Executions of one pipeline in the last ``days`` days; one with no start is kept."""
    df = filters.equals(raw, "pipeline_name", pipeline_name)
    df = filters.since_or_missing(df, "StartTime", days, as_of)
    return df.select(
        F.lit(pipeline_name).alias("pipeline_name"),
        F.col("PipelineExecutionArn").alias("execution_arn"),
        F.col("PipelineExecutionStatus").alias("status"),
        F.col("StartTime").alias("start_time"),
        F.col("LastModifiedTime").alias("last_modified_time"),
    )


def _ml_jobs(raw: DataFrame, field: str, name_contains: str, days: int, as_of: Instant, ordered: bool) -> DataFrame:
    df = filters.contains(raw, f"{field}JobName", name_contains)
    df = filters.since_or_missing(df, "CreationTime", days, as_of).select(
        F.col(f"{field}JobName").alias(f"{field.lower()}_job_name"),
        F.col(f"{field}JobStatus").alias("status"),
        F.col("CreationTime").alias("creation_time"),
        F.col(f"{field}EndTime").alias("end_time"),
    )
    return df.orderBy(F.desc("creation_time"), f"{field.lower()}_job_name") if ordered else df


def training_jobs(
    raw: DataFrame, name_contains: str = "", days: int = 7, *, as_of: Instant, ordered: bool = True
) -> DataFrame:
    """Training jobs of the last ``days`` days, newest first."""
    return _ml_jobs(raw, "Training", name_contains, days, as_of, ordered)


def processing_jobs(
    raw: DataFrame, name_contains: str = "", days: int = 7, *, as_of: Instant, ordered: bool = True
) -> DataFrame:
    """Processing jobs of the last ``days`` days, newest first."""
    return _ml_jobs(raw, "Processing", name_contains, days, as_of, ordered)


def stacks(raw: DataFrame, name_prefix: str = "", days: int = 7, *, as_of: Instant) -> DataFrame:
    """Stacks created in the last ``days`` days; one with no creation time is kept."""
    df = filters.since_or_missing(filters.prefix(raw, "StackName", name_prefix), "CreationTime", days, as_of)
    return df.select(
        F.col("StackName").alias("stack_name"),
        F.col("StackId").alias("stack_id"),
        F.col("CreationTime").alias("creation_time"),
        F.col("LastUpdatedTime").alias("last_updated_time"),
        F.col("DeletionTime").alias("deletion_time"),
        F.col("StackStatus").alias("stack_status"),
        F.col("StackStatusReason").alias("stack_status_reason"),
        F.col("TemplateDescription").alias("template_description"),
    )
