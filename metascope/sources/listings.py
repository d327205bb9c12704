"""Typed listings of landed records, with the filters each listing offers.

Filters are put on the raw columns, before any value is computed, so that they
reach the scan.  ``extended`` adds columns; without it their fields are not
read at all.  Missing text and numbers get the listing's defaults; times stay
NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.literals import Instant
from ..operators import filters, lookups
from ..operators.projection import default


def objects(
    raw: DataFrame,
    *,
    bucket: str | None = None,
    prefix: str = "",
    min_size: int | str | None = None,
    max_size: int | str | None = None,
    newer_than: Instant | None = None,
    older_than: Instant | None = None,
    as_of: Instant | None = None,
    extended: bool = False,
) -> DataFrame:
    """Stored objects; the ``bucket`` column is kept if the records have one."""
    df = filters.equals(raw, "bucket", bucket)
    df = filters.prefix(df, "Key", prefix)
    df = filters.in_range(df, "Size", min_size, max_size)
    df = filters.in_period(df, "LastModified", newer_than, older_than, as_of)
    out = [F.col("bucket")] if "bucket" in raw.columns else []
    out += [
        F.col("Key").alias("key"),
        F.col("Size").alias("size"),
        F.col("LastModified").alias("last_modified"),
        default("StorageClass", "STANDARD").alias("storage_class"),
    ]
    if extended:
        out += [C.unquote("ETag").alias("etag"), default("Owner.DisplayName", "").alias("owner")]
    return df.select(*out)


def catalog_tables(raw: DataFrame, database: str | None = "default", prefix: str = "", extended: bool = False) -> DataFrame:
    """Tables of one catalog database, or of all if it is None, with their storage.

    Records of several databases carry a ``database`` column, which is then
    filtered.  Storage columns are NULL where there is no storage descriptor.
    """
    df = filters.equals(raw, "database", database) if "database" in raw.columns else raw
    df = filters.prefix(df, "Name", prefix)
    storage = F.col("StorageDescriptor")
    serde = storage["SerdeInfo"]

    def stored(value):
        return F.when(storage.isNotNull(), value)

    out = [
        (F.col("database") if database is None and "database" in raw.columns else F.lit(database)).alias("database"),
        F.col("Name").alias("table"),
        default("TableType", "EXTERNAL_TABLE").alias("type"),
        F.col("CreateTime").alias("created_time"),
        F.col("UpdateTime").alias("updated_time"),
        stored(default(storage["Location"], "")).alias("location"),
        stored(C.last_segment(storage["InputFormat"])).alias("input_format"),
        stored(C.last_segment(storage["OutputFormat"])).alias("output_format"),
        F.when(serde.isNotNull(), C.last_segment(serde["SerializationLibrary"])).alias("serde"),
    ]
    if extended:
        no_properties = F.from_json(F.lit("{}"), "map<string,string>")
        out += [
            C.cardinality(storage["Columns"]).alias("column_count"),
            C.named_types(storage["Columns"]).alias("columns"),
            C.cardinality("PartitionKeys").alias("partition_count"),
            C.names_of("PartitionKeys").alias("partition_keys"),
            F.coalesce("Parameters", no_properties).alias("properties"),
            C.table_size("Parameters").alias("size_bytes"),
        ]
    return df.select(*out)


def jobs(
    raw: DataFrame,
    *,
    prefix: str = "",
    status: str | None = None,
    runs: DataFrame | None = None,
    keep_never_run: bool = False,
    extended: bool = False,
) -> DataFrame:
    """Job definitions; with ``runs`` (see ``all_job_runs``) also their last run.

    The last run is joined only if it is asked for, by a status or by
    ``extended``.
    """
    df = filters.prefix(raw, "Name", prefix)
    out = [
        F.col("Name").alias("name"),
        default("Role", "").alias("role"),
        F.col("CreatedOn").alias("created_on"),
        default("MaxCapacity", 0.0).alias("max_capacity"),
    ]
    more = [
        default("Description", "").alias("description"),
        default("Command.Name", "").alias("command"),
        default("Command.ScriptLocation", "").alias("script_location"),
        default("MaxRetries", 0).alias("max_retries"),
        default("Timeout", 0).alias("timeout"),
    ]
    df = df.select(*out, *(more if extended else []))
    if not (status or extended):
        return df
    if runs is None:
        if status:
            raise ValueError("a status filter needs the runs")
        return df
    return lookups.jobs_with_last_run(df, runs, status, keep_never_run)


def all_job_runs(raw: DataFrame) -> DataFrame:
    """Runs of all jobs, typed."""
    return raw.select(
        F.col("JobName").alias("job_name"),
        F.col("Id").alias("id"),
        F.col("JobRunState").alias("status"),
        F.col("StartedOn").alias("started_on"),
        F.col("CompletedOn").alias("completed_on"),
        F.col("ExecutionTime").alias("execution_time"),
    )


# What differs between the three kinds of model jobs: the prefix of their field
# names, and where their details hold instance type and count.
_ML_KINDS = {
    "training": ("Training", "ResourceConfig"),
    "processing": ("Processing", "ProcessingResources.ClusterConfig"),
    "transform": ("Transform", "TransformResources"),
}


def ml_jobs(
    kind: str,
    raw: DataFrame,
    *,
    name_contains: str = "",
    prefix: str = "",
    status: str | None = None,
    details: DataFrame | None = None,
    miss: str = "null",
) -> DataFrame:
    """Training, processing or transform jobs; ``details`` adds the extended columns.

    A transform job's seconds are computed from its times; the other kinds
    report theirs.
    """
    field, resources = _ML_KINDS[kind]
    df = filters.listing(
        raw,
        f"{field}JobName",
        name_prefix=prefix,
        name_contains=name_contains,
    )
    df = filters.equals(df, f"{field}JobStatus", status)
    end = F.col(f"{field}EndTime")
    seconds = C.whole_seconds("CreationTime", end) if kind == "transform" else default(f"{field}TimeInSeconds", 0)
    df = df.select(
        F.col(f"{field}JobName").alias("name"),
        F.col(f"{field}JobStatus").alias("status"),
        F.col("CreationTime").alias("created_time"),
        end.alias("end_time"),
        seconds.alias(f"{kind}_time_seconds"),
        F.lit(kind).alias("type"),
    )
    if details is None:
        return df
    last = ("ModelName", "model_name") if kind == "transform" else ("RoleArn", "role_arn")
    return lookups.enrich(
        df,
        details.withColumnRenamed(f"{field}JobName", "name"),
        "name",
        {
            "instance_type": default(f"{resources}.InstanceType", ""),
            "instance_count": default(f"{resources}.InstanceCount", 0),
            last[1]: default(last[0], ""),
        },
        miss,
    )


def training_jobs(raw: DataFrame, **options) -> DataFrame:
    return ml_jobs("training", raw, **options)


def processing_jobs(raw: DataFrame, **options) -> DataFrame:
    return ml_jobs("processing", raw, **options)


def transform_jobs(raw: DataFrame, **options) -> DataFrame:
    return ml_jobs("transform", raw, **options)


def stacks(
    raw: DataFrame,
    *,
    prefix: str = "",
    regex: str | None = None,
    tags=None,
    tag_rows: DataFrame | None = None,
    statuses=None,
    extended: bool = False,
) -> DataFrame:
    """Infrastructure stacks; tags are looked up by stack name, last."""
    df = filters.listing(
        raw, "StackName", name_prefix=prefix, name_regex=regex, status=statuses, status_column="StackStatus"
    )
    out = [
        F.col("StackName").alias("stack_name"),
        F.col("StackId").alias("stack_id"),
        F.col("CreationTime").alias("creation_time"),
        F.col("LastUpdatedTime").alias("last_updated_time"),
        F.col("StackStatus").alias("stack_status"),
        F.col("TemplateDescription").alias("template_description"),
    ]
    if extended:
        out += [
            F.col("DeletionTime").alias("deletion_time"),
            F.col("StackStatusReason").alias("stack_status_reason"),
            F.col("DriftInformation").alias("drift_information"),
        ]
    df = df.select(*out)
    return lookups.having_tags(df, "stack_name", tag_rows, tags) if tag_rows is not None else df


def streams(raw: DataFrame, *, prefix: str = "", details: DataFrame | None = None, miss: str = "error") -> DataFrame:
    """Stream names; ``details`` adds state, mode, shards and monitoring.

    A stream described over several pages has several detail rows, whose shards
    are put together; a shard that landed twice counts once.
    """
    df = filters.prefix(raw, "StreamName", prefix).select(F.col("StreamName").alias("name"))
    if details is None:
        return df
    first_metrics = C.first_element("EnhancedMonitoring")["ShardLevelMetrics"]
    monitored = C.cardinality("EnhancedMonitoring") > 0
    no_metrics = F.array().cast("array<string>")
    # A row per shard, and one for a page without any.
    by_shard = details.select("*", F.explode_outer("Shards.ShardId").alias("shard"))
    landed = F.col(lookups.LANDED) if lookups.LANDED in details.columns else F.lit(0)

    def newest(column: str) -> Column:
        """Of the pages that have it the one that landed last counts."""
        value = F.col(column)
        return F.max(F.when(value.isNotNull(), F.struct(landed.alias("at"), value.alias("value"))))["value"]

    described = by_shard.groupBy(F.col("StreamName").alias("name")).agg(
        newest("StreamStatus").alias("status"),
        newest("StreamModeDetails.StreamMode").alias("mode"),
        newest("RetentionPeriodHours").alias("retention_hours"),
        F.count_distinct("shard").cast("int").alias("shard_count"),
        F.max("StreamCreationTimestamp").alias("created_at"),
        F.max("StreamARN").alias("arn"),
        F.max(F.when(monitored, F.coalesce(first_metrics, no_metrics))).alias("monitoring_level"),
    )
    plain = ["status", "retention_hours", "shard_count", "created_at", "arn", "monitoring_level"]
    columns = {c: F.col(c) for c in plain} | {"mode": default("mode", "PROVISIONED")}
    return lookups.enrich(df, described, "name", columns, miss)


def state_machines(
    raw: DataFrame,
    *,
    prefix: str = "",
    regex: str | None = None,
    tags=None,
    tag_rows: DataFrame | None = None,
    details: DataFrame | None = None,
    miss: str = "sentinel",
) -> DataFrame:
    """Workflow state machines; tags are looked up by ARN and are not trimmed."""
    df = filters.listing(raw, "name", name_prefix=prefix, name_regex=regex).select(
        "name", F.col("stateMachineArn").alias("arn"), "type", F.col("creationDate").alias("creation_date")
    )
    if tag_rows is not None:
        df = lookups.having_tags(df, "arn", tag_rows, tags, trim=False)
    if details is None:
        return df
    return lookups.enrich(
        df,
        details.withColumnRenamed("stateMachineArn", "arn"),
        "arn",
        {"status": default("status", "UNKNOWN"), "role_arn": default("roleArn", "")},
        miss,
        sentinel=("status", "ERROR_FETCHING_DETAILS"),
    )


def recent_failures(
    raw: DataFrame, *, machine_arn: str | None = None, days: int = 7, as_of: Instant
) -> DataFrame:
    """Failed executions of the last ``days`` days, cutoff excluded, without their input."""
    df = filters.equals(raw, "stateMachineArn", machine_arn)
    df = filters.equals(df, "status", "FAILED")
    return filters.after(df, "startDate", days, as_of).select(
        F.col("executionArn").alias("execution_arn"),
        "name",
        F.col("startDate").alias("start_date"),
        F.col("stateMachineArn").alias("machine_arn"),
    )


def with_inputs(executions: DataFrame, inputs: DataFrame) -> DataFrame:
    """Executions with their input, ``{}`` where it has none, and whether it has landed (``input_found``).

    Inputs are the widest data here: filter and join the executions first.  An
    execution whose input has not landed is kept, with a NULL input.
    """
    texts = inputs.select(F.col("executionArn").alias("execution_arn"), default("input", "{}").alias("input"))
    found = lookups.one_per_key(texts, "execution_arn").withColumn("input_found", F.lit(True))
    joined = executions.join(found, "execution_arn", "left")
    return joined.withColumn("input_found", F.coalesce("input_found", F.lit(False)))


def failed_executions(
    raw: DataFrame,
    inputs: DataFrame,
    *,
    machine_arn: str | None = None,
    days: int = 7,
    as_of: Instant,
) -> DataFrame:
    """Failed executions of the last ``days`` days with their input."""
    return with_inputs(recent_failures(raw, machine_arn=machine_arn, days=days, as_of=as_of), inputs)
