"""Listings, in lister and export form."""

from pyspark.sql import functions as F

from ..fixtures import EVENTS_AS_OF, OBJECTS_AS_OF, RUNS_AS_OF
from ..session import work_dir
from ..sources import exports, listings, pages
from .registry import iso, query

# A job with runs before, in and without the period, at all scales.
JOB_WITH_RUNS = "building-711"

STORED = "coalesce(storage_class, 'STANDARD') as storage_class"


@query(
    "src0_page_envelopes",
    f"""select bucket, key, size, {iso("last_modified")}, {STORED}, trim(etag, '"') as etag,
        coalesce(owner_name, '') as owner from objects""",
)
def _(fx):
    """Lands the inventory as JSON pages and reads them back.

    A page holds the items of 200 orders of a bucket, which are 1,400 at most;
    one page per bucket has no records.
    """
    raw = fx.raw_objects
    record = F.struct(*[c for c in raw.columns if c != "bucket"])
    page = F.floor(F.split_part("Key", F.lit("/"), F.lit(2)).cast("bigint") / 200)
    full = raw.groupBy("bucket", page.alias("page")).agg(F.collect_list(record).alias("Contents"))
    landed = full.select("bucket", F.to_json(F.struct("Contents")).alias("value"))
    empty = raw.select("bucket").distinct().withColumn("value", F.lit('{"KeyCount":0}'))
    path = work_dir(fx.spark, "pages")
    landed.unionByName(empty).write.partitionBy("bucket").text(path, compression="gzip")
    return listings.objects(pages.read_pages(fx.spark, path, "objects"), extended=True)


@query(
    "src0_damaged_pages",
    """select event_id, case when event_id % 7 = 0 then null else cast(user_id as varchar) end as key,
        event_id % 7 = 0 as damaged from events""",
)
def _(fx):
    """A page per event, of which some are cut off; those come as rows of their own."""
    record = F.to_json(F.struct(F.array(F.struct(F.col("user_id").cast("string").alias("Key"))).alias("Contents")))
    cut = F.when(F.col("event_id") % 7 == 0, F.substr(record, F.lit(1), F.length(record) - 3)).otherwise(record)
    read = pages.records_of(fx.table("events").select("event_id", cut.alias("value")), "objects", on_damage="column")
    return read.select("event_id", F.col("Key").alias("key"), F.col(pages.DAMAGED).isNotNull().alias("damaged"))


TAGS = """(select resource_id, key, value, seq from (
    select {id} as resource_id, 'Env' as key, env as value, 0 as seq from tag_lists where tagged
    union all select {id}, 'Env', 'Dev', 1 from tag_lists where tagged and again) t)"""


def landed_tags(fx, resource: str, tags: str, key: str, value: str):
    """Tag lists as the services return them, landed as JSON and read back."""
    rows = fx.view("tag_lists")

    def pair(tag):
        return F.struct(F.lit("Env").alias(key), tag.alias(value))

    listed = F.when(F.col("again"), F.array(pair(F.col("env")), pair(F.lit("Dev")))).otherwise(F.array(pair(F.col("env"))))
    records = rows.select(F.col("name" if tags == "Tags" else "arn").alias(resource), F.when(F.col("tagged"), listed).alias(tags))
    path = work_dir(fx.spark, "tags")
    records.select(F.to_json(F.struct("*")).alias("value")).write.text(path)
    return pages.read_tags(fx.spark, path, resource, tags, key, value)


@query("src_tags_of_stacks", f"select * from {TAGS.format(id='name')}")
def _(fx):
    return landed_tags(fx, "StackName", "Tags", "Key", "Value")


@query("src_tags_of_machines", f"select * from {TAGS.format(id='arn')}")
def _(fx):
    return landed_tags(fx, "stateMachineArn", "tags", "key", "value")


@query(
    "src1_objects",
    f"select bucket, key, size, {iso('last_modified')}, {STORED} from objects",
)
def _(fx):
    return listings.objects(fx.raw_objects)


@query(
    "src1_objects_all_options",
    f"""select bucket, key, size, {iso("last_modified")}, {STORED}, trim(etag, '"') as etag,
        coalesce(owner_name, '') as owner from objects
        where bucket = 'A' and key like 'F/%' and size >= 10240 and size <= 40960
          and last_modified >= timestamp '{OBJECTS_AS_OF}' - interval '2800' day
          and last_modified <= timestamp '2001-06-30'""",
)
def _(fx):
    return listings.objects(
        fx.raw_objects,
        bucket="A",
        prefix="F/",
        min_size="10KB",
        max_size="40kb",
        newer_than="400 weeks ago",
        older_than="2001-06-30",
        as_of=OBJECTS_AS_OF,
        extended=True,
    )


@query(
    "src1_objects_export",
    f"select key, {iso('last_modified')}, size, storage_class from objects where bucket = 'N' and key like 'O/%'",
)
def _(fx):
    return exports.objects(fx.raw_objects, "N", "O/")


CATALOG = f"""database, table_name as "table", coalesce(table_type, 'EXTERNAL_TABLE') as type,
    {iso("create_time", "created_time")}, cast(null as varchar) as updated_time, location,
    list_last(string_split(input_format, '.')) as input_format, '' as output_format, 'Lazy' as serde"""


@query("src2_catalog_tables", f"select {CATALOG} from catalog_tables where database = 'Brand#13' and table_name like 'red%'")
def _(fx):
    return listings.catalog_tables(fx.raw_catalog_tables, "Brand#13", "red")


@query(
    "src2_catalog_tables_extended",
    f"""select {CATALOG}, cast(partition_count + 1 as int) as column_count, cast(partition_count as int) as partition_count,
        case partition_count when 0 then '' when 1 then 'k1' when 2 then 'k1,k2' else 'k1,k2,k3' end as partition_keys,
        cast(coalesce(total_size, raw_data_size) as bigint) as size_bytes
        from catalog_tables where database = 'Brand#13'""",
)
def _(fx):
    tables = listings.catalog_tables(fx.raw_catalog_tables, "Brand#13", extended=True)
    return tables.drop("columns", "properties").withColumn("partition_keys", F.array_join("partition_keys", ","))


@query(
    "src3_catalog_metadata",
    f"""select table_name as name, {iso("create_time")}, cast(null as varchar) as last_access_time, table_type
        from catalog_tables where database = 'Brand#12'""",
)
def _(fx):
    return exports.catalog_metadata(fx.raw_catalog_tables, "Brand#12")


JOB = f"""name, coalesce(role, '') as role, {iso("created_on")}, coalesce(max_capacity, 0.0) as max_capacity"""


@query("src4_jobs", f"select {JOB} from jobs where name like 'b%'")
def _(fx):
    return listings.jobs(fx.raw_jobs, prefix="b")


@query(
    "src4_jobs_extended",
    f"""select {JOB}, '' as description, coalesce('etl-' || role, '') as command,
        case when role is null or job_id % 3 = 0 then '' else 's3://scripts/' || name end as script_location,
        cast(job_id % 4 as int) as max_retries, 60 as timeout from jobs""",
)
def _(fx):
    return listings.jobs(fx.raw_jobs, extended=True)


@query(
    "src4_jobs_export",
    f"""select name, role, {iso("created_on")}, {iso("created_on", "last_modified_on")}, max_capacity from jobs""",
)
def _(fx):
    return exports.jobs(fx.raw_jobs)


@query(
    "src5_job_runs",
    f"""select job_name, id, status, {iso("started_on")}, cast(null as varchar) as completed_on from job_runs
        where job_name = '{JOB_WITH_RUNS}' and (started_on is null or started_on >= timestamp '{RUNS_AS_OF}' - interval '400' day)""",
)
def _(fx):
    return exports.job_runs(fx.raw_job_runs, JOB_WITH_RUNS, 400, as_of=RUNS_AS_OF)


@query(
    "src6_query_errors",
    f"""select query_id, workgroup, {iso("submission_time")}, reason as failure_reason from query_executions
        where workgroup = 'wg0' and state = 'FAILED' and submission_time >= timestamp '2024-01-24'""",
)
def _(fx):
    ids, details = fx.raw_queries
    return exports.query_errors(ids, details, "wg0", 7, as_of=EVENTS_AS_OF)


@query(
    "src7_flow_executions",
    f"""select pipeline_name, execution_arn, status, {iso("start_time")}, {iso("last_modified_time")}
        from pipeline_executions
        where pipeline_name = 'pipe-3' and (start_time is null or start_time >= timestamp '2024-01-24')""",
)
def _(fx):
    return exports.pipeline_executions(fx.raw_pipeline_executions, "pipe-3", as_of=EVENTS_AS_OF)


def _lister(kind: str) -> str:
    return f"""name, status, {iso("creation_time", "created_time")}, {iso("end_time")},
        seconds as {kind}_time_seconds, '{kind}' as type"""


@query(
    "src8_training_jobs",
    f"select {_lister('training')} from ml_jobs where type = 'training' and status = 'Completed'",
)
def _(fx):
    return listings.training_jobs(fx.raw_ml_jobs("training"), status="Completed")


def _export(kind: str) -> str:
    return f"""select name as {kind}_job_name, status, {iso("creation_time")}, {iso("end_time")} from ml_jobs
        where type = '{kind}' and contains(name, 'v2-8') and creation_time >= timestamp '2024-01-24'"""


@query("src9_training_jobs_export", _export("training"))
def _(fx):
    return exports.training_jobs(fx.raw_ml_jobs("training"), "v2-8", as_of=EVENTS_AS_OF)


@query(
    "src10_processing_jobs",
    f"select {_lister('processing')} from ml_jobs where type = 'processing' and contains(name, 'v1-')",
)
def _(fx):
    return listings.processing_jobs(fx.raw_ml_jobs("processing"), name_contains="v1-")


@query("src11_processing_jobs_export", _export("processing"))
def _(fx):
    return exports.processing_jobs(fx.raw_ml_jobs("processing"), "v2-8", as_of=EVENTS_AS_OF)


@query(
    "src12_transform_jobs",
    f"""select name, status, {iso("creation_time", "created_time")}, {iso("end_time")},
        case when end_time is not null then want end as transform_time_seconds, 'transform' as type from transform_jobs""",
)
def _(fx):
    return listings.transform_jobs(fx.raw_ml_jobs("transform"))


STACK = f"""stack_name, cast(stack_id as varchar) as stack_id, {iso("creation_time")},
    cast(null as varchar) as last_updated_time, stack_status, cast(null as varchar) as template_description"""


@query(
    "src13_stacks",
    f"""select {STACK} from stacks where stack_name like 'b%' and contains(stack_name, '-prod-')
        and stack_status in ('CREATE_COMPLETE', 'UPDATE_COMPLETE')""",
)
def _(fx):
    return listings.stacks(
        fx.raw_stacks, prefix="b", regex=".*-prod-.*", statuses="CREATE_COMPLETE, UPDATE_COMPLETE"
    )


@query(
    "src13_stacks_extended",
    f"""select {STACK}, case when stack_status = 'DELETE_COMPLETE' then {iso("creation_time").removesuffix(" as creation_time")} end
        as deletion_time, case when stack_status = 'DELETE_COMPLETE' then 'gone' end as stack_status_reason,
        '{{"StackDriftStatus":"IN_SYNC"}}' as drift_information from stacks""",
)
def _(fx):
    return listings.stacks(fx.raw_stacks, extended=True)


@query(
    "src14_stacks_export",
    f"""select stack_name, cast(stack_id as varchar) as stack_id, {iso("creation_time")},
        cast(null as varchar) as last_updated_time,
        case when stack_status = 'DELETE_COMPLETE' then {iso("creation_time").removesuffix(" as creation_time")} end
        as deletion_time, stack_status, case when stack_status = 'DELETE_COMPLETE' then 'gone' end as stack_status_reason,
        cast(null as varchar) as template_description
        from stacks where creation_time is null or creation_time >= timestamp '2024-01-24'""",
)
def _(fx):
    return exports.stacks(fx.raw_stacks, as_of=EVENTS_AS_OF)


@query("src15_streams", "select name from streams")
def _(fx):
    return listings.streams(fx.raw_streams)


@query(
    "src15_streams_extended",
    """select name, case when hit then status end as status, case when hit then coalesce(mode, 'PROVISIONED') end as mode,
        case when hit then 24 end as retention_hours, case when hit then cast(shard_count as int) end as shard_count,
        case when hit then '2024-01-01T00:00:00+00:00' end as created_at, case when hit then 'arn:st:' || name end as arn,
        case when hit and shard_count % 3 <> 0 then '["IncomingBytes","OutgoingBytes"]' end as monitoring_level,
        case when not hit then 'details not found' end as error
        from (select *, shard_count % 5 <> 4 as hit from streams) s""",
)
def _(fx):
    return listings.streams(fx.raw_streams, details=fx.stream_details)


@query("src16_state_machines", f"select name, arn, type, {iso('creation_date')} from state_machines where name like 'wf-0%'")
def _(fx):
    return listings.state_machines(fx.raw_state_machines, prefix="wf-0")


@query(
    "src17_failed_executions",
    f"""select execution_arn, name, {iso("start_date")}, case when input_found then coalesce(input, '{{}}') end as input, machine_arn,
        input_found from executions
        where status = 'FAILED' and start_date > timestamp '2024-01-24'""",
)
def _(fx):
    return listings.failed_executions(fx.raw_executions, fx.execution_inputs, as_of=EVENTS_AS_OF)
