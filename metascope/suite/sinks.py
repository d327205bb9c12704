"""Sinks: each query writes and returns what is read back."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import EVENTS_AS_OF, RUNS_AS_OF
from ..session import work_dir
from ..sinks import files, tables
from ..sources import listings
from .registry import iso, query
from .sources import JOB_WITH_RUNS

REPORT = f"""key, size, {iso("last_modified")}, coalesce(storage_class, 'STANDARD') as storage_class"""


@query("snk1_table", f"select bucket, {REPORT} from objects")
def _(fx):
    objects = listings.objects(fx.raw_objects)
    return tables.save_table(objects, "object_inventory", path=work_dir(fx.spark, "table"), partition_by=["bucket"])


@query("snk2_jsonl", f"select {REPORT} from objects")
def _(fx):
    path = work_dir(fx.spark, "jsonl")
    files.write_jsonl(listings.objects(fx.raw_objects), path, "key,size,last_modified,storage_class")
    return fx.spark.read.schema("key string, size bigint, last_modified string, storage_class string").json(path)


@query(
    "snk3_tsv",
    f"""select concat_ws(chr(9), name, coalesce(role, ''), coalesce({iso("created_on").removesuffix(" as created_on")}, ''),
          '') as value from jobs union all select concat_ws(chr(9), 'name', 'role', 'created_on', 'nothing')""",
)
def _(fx):
    path = work_dir(fx.spark, "tsv")
    files.write_tsv(listings.jobs(fx.raw_jobs), path, "name,role,created_on,nothing")
    return fx.spark.read.text(path)


@query(
    "snk4_csv",
    """select execution_arn, case when input_found then coalesce(input, '{}') end as input, machine_arn from executions
        where status = 'FAILED' and start_date > timestamp '2024-01-24'""",
)
def _(fx):
    failed = listings.failed_executions(fx.raw_executions, fx.execution_inputs, as_of=EVENTS_AS_OF)
    path = work_dir(fx.spark, "csv")
    files.write_csv(failed, path, "execution_arn,input,machine_arn")
    reader = fx.spark.read.schema("execution_arn string, input string, machine_arn string")
    return reader.option("header", "true").option("escape", '"').csv(path)


@query(
    "snk4_storage_report",
    """select key, cast(size as varchar) as size, coalesce(storage_class, 'STANDARD') as storage_class from objects""",
)
def _(fx):
    path = work_dir(fx.spark, "report")
    files.write_csv(listings.objects(fx.raw_objects), path, "key,size,storage_class")
    return fx.spark.read.schema("key string, size string, storage_class string").option("header", "true").csv(path)


@query(
    "snk6_exports",
    """select 's3_objects' as table_name, count(*) as n from objects where bucket = 'A'
        union all select 'athena_tables', count(*) from catalog_tables where database = 'Brand#13'
        union all select 'glue_jobs', count(*) from jobs
        union all select 'glue_job_runs', count(*) from job_runs where job_name = 'building-711'
          and (started_on is null or started_on >= timestamp '2000-08-01')
        union all select 'athena_query_errors', count(*) from query_executions
          where workgroup = 'wg0' and state = 'FAILED' and submission_time >= timestamp '2024-01-24'
        union all select 'sm_pipeline_executions', count(*) from pipeline_executions
          where pipeline_name = 'pipe-3' and (start_time is null or start_time >= timestamp '2024-01-24')
        union all select 'sm_' || type || '_jobs', count(*) from ml_jobs
          where type <> 'transform' and creation_time >= timestamp '2024-01-24' group by type
        union all select 'cloudformation_stacks', count(*) from stacks
          where creation_time is null or creation_time >= timestamp '2024-01-24'""",
)
def _(fx):
    """All nine exports, with the number of rows in each table."""
    events = {"as_of": EVENTS_AS_OF}
    wanted: list[tuple[str, tuple[DataFrame, ...], dict]] = [
        ("s3", (fx.raw_objects,), {"bucket": "A"}),
        ("athena", (fx.raw_catalog_tables,), {"database": "Brand#13"}),
        ("glue-jobs", (fx.raw_jobs,), {}),
        ("glue-job-runs", (fx.raw_job_runs,), {"job_name": JOB_WITH_RUNS, "days": 365, "as_of": RUNS_AS_OF}),
        ("athena-errors", fx.raw_queries, {"workgroup": "wg0"} | events),
        ("sm-pipeline-executions", (fx.raw_pipeline_executions,), {"pipeline_name": "pipe-3"} | events),
        ("sm-training-jobs", (fx.raw_ml_jobs("training"),), events),
        ("sm-processing-jobs", (fx.raw_ml_jobs("processing"),), events),
        ("cloudformation", (fx.raw_stacks,), events),
    ]
    base = work_dir(fx.spark, "exports")
    counts = []
    for listing, records, options in wanted:
        saved = tables.export(fx.spark, listing, *records, path=f"{base}/{listing}", **options)
        counts.append(saved.agg(F.lit(tables.EXPORTS[listing][0]).alias("table_name"), F.count("*").alias("n")))
    return reduce(DataFrame.unionAll, counts)
