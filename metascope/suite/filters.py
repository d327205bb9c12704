"""Projections and filters."""

from pyspark.sql import functions as F

from ..fixtures import EVENTS_AS_OF, OBJECTS_AS_OF, RUNS_AS_OF
from ..functions import columns as C
from ..operators import filters as f
from ..operators import ordering, unions
from ..operators.projection import default, labelled, project
from ..sources import listings
from .registry import LATEST, iso, query


@query("prj1_field_list", "select key, size, '' as nothing from objects")
def _(fx):
    return project(listings.objects(fx.raw_objects), " key, size ,nothing")


@query(
    "prj2_defaults",
    """select name, coalesce(role, '') as role, coalesce(max_capacity, 0.0) as max_capacity from jobs""",
)
def _(fx):
    return fx.view("jobs").select(
        "name", default("role", "").alias("role"), default("max_capacity", 0.0).alias("max_capacity")
    )


@query(
    "prj2_default_classes",
    "select coalesce(storage_class, 'STANDARD') as storage_class, count(*) as n from objects group by 1",
)
def _(fx):
    return listings.objects(fx.raw_objects).groupBy("storage_class").agg(F.count("*").alias("n"))


@query(
    "prj3_extended_objects",
    """select key, trim(etag, '"') as etag, coalesce(owner_name, '') as owner from objects""",
)
def _(fx):
    return project(listings.objects(fx.raw_objects, extended=True), "key,etag,owner")


@query("prj4_labels", "select 'training' as type, 'models' as service, name from ml_jobs where type = 'training'")
def _(fx):
    jobs = listings.training_jobs(fx.raw_ml_jobs("training")).select("name")
    return labelled(jobs, type="training", service="models")


@query(
    "prj5_nested_fields",
    """select name, coalesce(instance_type, '') as instance_type, coalesce(instance_count, 0) as instance_count
        from ml_jobs where type = 'processing' and instance_type is not null""",
)
def _(fx):
    cluster = "ProcessingResources.ClusterConfig"
    return fx.ml_details("processing").select(
        F.col("ProcessingJobName").alias("name"),
        default(f"{cluster}.InstanceType", "").alias("instance_type"),
        default(f"{cluster}.InstanceCount", 0).alias("instance_count"),
    )


@query("flt1_prefix", "select bucket, key from objects where key like 'F/1%'")
def _(fx):
    return f.prefix(listings.objects(fx.raw_objects), "key", "F/1").select("bucket", "key")


@query(
    "flt1_instance_prefix",
    """select type, name, instance_type from ml_jobs where type <> 'transform' and instance_type like 'ml.p3%'
        union all select 'transform', name, instance_type from transform_jobs where instance_type like 'ml.p3%'""",
)
def _(fx):
    """Model jobs of all types on one family of instances."""
    parts = [listings.ml_jobs(k, fx.raw_ml_jobs(k), details=fx.ml_details(k)) for k in unions.ML_TYPES]
    return f.prefix(unions.ml_jobs(*parts), "instance_type", "ml.p3").select("type", "name", "instance_type")


@query("flt2_contains", "select name from ml_jobs where contains(name, 'v2-1')")
def _(fx):
    return f.contains(fx.view("ml_jobs"), "name", "v2-1").select("name")


@query("flt2_location_contains", "select table_name as name from catalog_tables where contains(location, 's3://eco')")
def _(fx):
    return f.contains(fx.view("catalog_tables"), "location", "s3://eco").select(F.col("table_name").alias("name"))


@query("flt3_regex", r"select stack_name from stacks where regexp_matches(stack_name, '-(prod|stage)-\d*7')")
def _(fx):
    return f.matches(fx.view("stacks"), "stack_name", r"-(?P<env>prod|stage)-\d*7").select("stack_name")


@query("flt4_status", "select name, status from ml_jobs where status = 'Failed'")
def _(fx):
    return f.equals(fx.view("ml_jobs"), "status", "Failed").select("name", "status")


@query(
    "flt5_status_list",
    "select stack_name, stack_status from stacks where stack_status in ('CREATE_COMPLETE', 'UPDATE_COMPLETE')",
)
def _(fx):
    return f.one_of(fx.view("stacks"), "stack_status", "CREATE_COMPLETE, UPDATE_COMPLETE").select(
        "stack_name", "stack_status"
    )


@query("flt6_tag_map", "select stack_name from stacks where contains(stack_name, '-prod-') and tag_text like '%Team=BUILDING'")
def _(fx):
    tagged = fx.view("stacks").withColumn("tags", C.tag_map("tag_text"))
    return f.tagged(tagged, "Env=prod, Team = BUILDING,junk").select("stack_name")


@query("flt7_size_range", "select key, size from objects where size >= 51200 and size <= 61440")
def _(fx):
    return f.in_range(listings.objects(fx.raw_objects), "size", "50KB", "60KB").select("key", "size")


@query(
    "flt8_period",
    f"""select key, {iso("last_modified")} from objects
        where last_modified >= timestamp '2001-01-01' and last_modified <= timestamp '2001-06-30'""",
)
def _(fx):
    return f.in_period(listings.objects(fx.raw_objects), "last_modified", "2001-01-01", "2001-06-30").select(
        "key", "last_modified"
    )


@query(
    "flt8_period_relative",
    f"""select key from objects where last_modified >= timestamp '{OBJECTS_AS_OF}' - interval '210' day
        and last_modified <= timestamp '{OBJECTS_AS_OF}' - interval '3000' hour""",
)
def _(fx):
    objects = listings.objects(fx.raw_objects)
    return f.in_period(objects, "last_modified", "30 weeks ago", "3000 hours ago", OBJECTS_AS_OF).select("key")


@query(
    "flt9_since_or_missing",
    f"""select job_name, id, {iso("started_on")} from job_runs
        where started_on is null or started_on >= timestamp '2001-07-02'""",
)
def _(fx):
    runs = listings.all_job_runs(fx.raw_job_runs)
    return f.since_or_missing(runs, "started_on", 30, RUNS_AS_OF).select("job_name", "id", "started_on")


@query(
    "flt10_failed_since",
    """select query_id from query_executions where state = 'FAILED' and submission_time >= timestamp '2024-01-24'""",
)
def _(fx):
    return f.failed_since(fx.view("query_executions"), "state", "submission_time", 7, EVENTS_AS_OF).select("query_id")


@query("flt11_after", "select execution_arn from executions where start_date > timestamp '2024-01-24'")
def _(fx):
    return f.after(fx.view("executions"), "start_date", 7, EVENTS_AS_OF).select("execution_arn")


@query(
    "flt12_parseable",
    f"""select id, {iso("ts")} from (select id, try_cast(text as timestamp) as ts from time_texts) t
        where ts is not null""",
)
def _(fx):
    return f.parseable(fx.view("time_texts"), "text", "ts").select("id", "ts")


@query(
    "flt13_all_filters",
    """select stack_name from stacks where stack_name like 'm%' and contains(stack_name, '-prod-')
        and stack_status in ('CREATE_COMPLETE', 'DELETE_COMPLETE') and tag_text like '%Team=MACHINERY'""",
)
def _(fx):
    stacks = fx.view("stacks").withColumn("tags", C.tag_map("tag_text"))
    return f.listing(
        stacks,
        "stack_name",
        name_prefix="m",
        name_contains="-",
        name_regex="prod",
        status="CREATE_COMPLETE,DELETE_COMPLETE",
        status_column="stack_status",
        tags={"Team": "MACHINERY", "Env": "prod"},
    ).select("stack_name")


@query("flt14_thresholds", "select name, seconds from ml_jobs where type = 'training' and seconds > 3600")
def _(fx):
    jobs = listings.training_jobs(fx.raw_ml_jobs("training"))
    return f.above(jobs, "training_time_seconds", 3600).select("name", F.col("training_time_seconds").alias("seconds"))


@query(
    "flt14_long_running_jobs",
    f"""select job_name as name, last_run_duration from {LATEST} r
        where last_run_status = 'RUNNING' and last_run_duration > 3600""",
)
def _(fx):
    runs = listings.all_job_runs(fx.raw_job_runs)
    jobs = listings.jobs(fx.raw_jobs, status="RUNNING", runs=runs)
    return f.above(jobs, "last_run_duration", 3600).select("name", "last_run_duration")


@query("flt14_partitioned", "select table_name from catalog_tables where partition_count > 0")
def _(fx):
    return f.above(fx.view("catalog_tables"), "partition_count", 0).select("table_name")


@query(
    "flt15_not_active",
    """select name, case when shard_count % 5 <> 4 then status end as status from streams
        where shard_count % 5 = 4 or status <> 'ACTIVE'""",
)
def _(fx):
    streams = listings.streams(fx.raw_streams, details=fx.stream_details)
    return f.differs(streams, "status", "ACTIVE").select("name", "status")


@query(
    "flt15_on_demand",
    "select name from streams where mode = 'ON_DEMAND' and shard_count % 5 <> 4",
)
def _(fx):
    return f.equals(listings.streams(fx.raw_streams, details=fx.stream_details), "mode", "ON_DEMAND").select("name")


@query(
    "flt_large_objects_of_a_bucket",
    """select key, size from objects where bucket = 'A' and key like 'F/1%' and size >= 50000
        order by size desc, key limit 100""",
)
def large_objects(fx):
    """The largest objects of one bucket under one prefix."""
    found = listings.objects(fx.raw_objects, bucket="A", prefix="F/1", min_size=50_000)
    return ordering.limit(project(found, "key,size"), 100, F.desc("size"), "key")
