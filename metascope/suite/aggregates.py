"""Totals, counts and unions."""

from pyspark.sql import functions as F

from ..fixtures import EVENTS_AS_OF
from ..operators import aggregates as a
from ..operators import filters, unions
from ..plans import actions, reports
from ..sources import listings
from .registry import LATEST, iso, query


def all_ml_jobs(fx, job_type: str = "all", detailed: bool = False):
    parts = [
        listings.ml_jobs(kind, fx.raw_ml_jobs(kind), details=fx.ml_details(kind) if detailed else None)
        for kind in unions.ML_TYPES
    ]
    return unions.ml_jobs(*parts, job_type=job_type)


# The union of the three listings, as a subquery.
ALL_ML = """(select type, name, status, creation_time, case when type = 'training' then seconds end as training_time_seconds,
    case when type = 'processing' then seconds end as processing_time_seconds, null as transform_time_seconds
    from ml_jobs where type <> 'transform'
    union all select 'transform', name, status, creation_time, null, null, case when end_time is not null then want end
    from transform_jobs)"""


@query("agg1_total_size", "select cast(sum(size) as bigint) as total_bytes from objects where key like 'F/1%'")
def _(fx):
    return a.total_size(listings.objects(fx.raw_objects, prefix="F/1"))


@query("agg2_count", "select count(*) as n from objects where key like 'O/%'")
def _(fx):
    return a.count_rows(listings.objects(fx.raw_objects, prefix="O/"))


@query(
    "agg3_by_type_and_status",
    f"""select type, status, count(*) as n, avg(training_time_seconds) as avg_training_seconds from {ALL_ML} j
        group by type, status""",
)
def by_type_and_status(fx):
    return a.by_type_and_status(all_ml_jobs(fx))


@query(
    "agg4_failures_by_token",
    f"""select split_part(job_name, '-', 1) as token, count(*) as n from {LATEST} r
        where last_run_status = 'FAILED' group by 1""",
)
def _(fx):
    runs = listings.all_job_runs(fx.raw_job_runs)
    return a.by_first_token(listings.jobs(fx.raw_jobs, status="FAILED", runs=runs))


SERVICES = """(select 'jobs' as service, name from jobs union all select 'streams', name from streams
    union all select 'tables', table_name from catalog_tables)"""


def all_services(fx):
    tables = fx.raw_catalog_tables.select(F.col("Name").alias("name"))
    return unions.services(jobs=listings.jobs(fx.raw_jobs), streams=listings.streams(fx.raw_streams), tables=tables)


@query("agg5_by_service", f"select service, count(*) as n from {SERVICES} s group by service")
def _(fx):
    return a.by_service(all_services(fx))


@query(
    "agg5_tag_audit",
    """select service, count(*) as n, count(*) filter (where r not in (select resource_id from audit_tags)) as n_untagged
        from (select 'jobs' as service, concat('job/', name) as r from jobs union all select 'streams', concat('stream/', name) from streams
          union all select 'machines', arn from state_machines) t group by service""",
)
def _(fx):
    """Untagged resources by service; tags are relations of all services together."""
    ids = {"jobs": ("jobs", F.concat(F.lit("job/"), "name")), "streams": ("streams", F.concat(F.lit("stream/"), "name")), "machines": ("state_machines", F.col("arn"))}
    parts = [fx.view(view).select(F.lit(service).alias("service"), key.alias("resource_id")) for service, (view, key) in ids.items()]
    return a.tag_audit(unions.union(*parts), fx.view("audit_tags"))


@query(
    "agg6_instance_hours",
    """select cast(sum(seconds) as bigint) as total_seconds, sum(seconds) / 3600 as total_hours from ml_jobs
        where type = 'training' and status = 'Completed' and instance_type = 'ml.p3.2xlarge'""",
)
def _(fx):
    jobs = listings.training_jobs(
        fx.raw_ml_jobs("training"), status="Completed", details=fx.ml_details("training")
    )
    return a.instance_hours(jobs, "ml.p3.2xlarge")


def _failures(join: str) -> str:
    return f"""select m.name, m.arn, count(e.execution_arn) as n from state_machines m {join} join
        (select * from executions where status = 'FAILED' and start_date > timestamp '2024-01-24') e
        on e.machine_arn = m.arn group by m.name, m.arn"""


def failed(fx):
    return listings.recent_failures(fx.raw_executions, as_of=EVENTS_AS_OF)


@query("agg7_failures_per_machine", _failures("inner"))
def _(fx):
    return a.failures_per_machine(listings.state_machines(fx.raw_state_machines), failed(fx))


@query("agg7_failures_or_none", _failures("left"))
def _(fx):
    return a.failures_per_machine(listings.state_machines(fx.raw_state_machines), failed(fx), include_none=True)


MACHINES = "(select * from state_machines where name like 'wf-0%')"
PLAN = f"""(select e.execution_arn as original_execution from {MACHINES} m join executions e on e.machine_arn = m.arn
    where e.status = 'FAILED' and e.start_date > timestamp '2024-01-24')"""


def machines_and_plan(fx):
    machines = listings.state_machines(fx.raw_state_machines)
    plan = actions.retry_plan(machines, fx.raw_executions, None, "wf-0", as_of=EVENTS_AS_OF)
    return filters.prefix(machines, "name", "wf-0"), plan


@query(
    "agg8_run_summary",
    f"""select (select count(*) from {MACHINES} m) as machines_checked, count(*) as failed_found,
        cast(sum(case when retry_started then 1 else 0 end) as bigint) as retried,
        cast(sum(case when retry_started then 0 else 1 end) as bigint) as failed_to_retry
        from {PLAN} p left join retry_attempts using (original_execution)""",
)
def _(fx):
    machines, plan = machines_and_plan(fx)
    return a.run_summary(machines, actions.retry_outcomes(plan, fx.view("retry_attempts")))


@query(
    "agg8_run_summary_dry",
    f"""select (select count(*) from {MACHINES} m) as machines_checked, count(*) as failed_found, count(*) as would_retry
        from {PLAN} p""",
)
def _(fx):
    return a.run_summary(*machines_and_plan(fx))


@query(
    "agg9_array_sizes",
    """select table_name as "table", cast(partition_count + 1 as int) as column_count,
        cast(partition_count as int) as partition_count from catalog_tables""",
)
def _(fx):
    tables = listings.catalog_tables(fx.raw_catalog_tables, None, extended=True)
    return tables.select("table", "column_count", "partition_count")


@query(
    "agg10_tag_maps",
    """select resource_id, max(case when key = 'Env' then value end) as env, max(case when key = 'Team' then value end) as team
        from (select resource_id, key, arg_max(value, seq) as value from resource_tags group by resource_id, key) t
        group by resource_id""",
)
def _(fx):
    maps = a.tags_as_map(fx.view("resource_tags"))
    return maps.select("resource_id", F.col("tags")["Env"].alias("env"), F.col("tags")["Team"].alias("team"))


@query(
    "set1_ml_jobs",
    f"""select type, name, status, {iso("creation_time", "created_time")}, training_time_seconds,
        processing_time_seconds, transform_time_seconds from {ALL_ML} j""",
)
def _(fx):
    return all_ml_jobs(fx).drop("end_time")


@query(
    "set1_processing_only",
    "select name, seconds as processing_time_seconds from ml_jobs where type = 'processing'",
)
def _(fx):
    return all_ml_jobs(fx, "processing").select("name", "processing_time_seconds")


@query("set2_services", f"select service, name from {SERVICES} s")
def _(fx):
    return all_services(fx)


@query(
    "set3_cost_report",
    """select * from (select 'large_objects' as section, key as name, null as instance_type, size / 1073741824 as metric from objects
          where size >= 102400 order by size desc, key limit 10) a
        union all select 'long_training', name, instance_type, seconds / 3600 from ml_jobs where type = 'training' and seconds > 7200
        union all select 'wide_streams', name, null, cast(shard_count as double) from streams
          where shard_count > 10 and shard_count % 5 <> 4""",
)
def _(fx):
    return reports.cost_report(
        listings.objects(fx.raw_objects),
        listings.training_jobs(fx.raw_ml_jobs("training"), details=fx.ml_details("training")),
        listings.streams(fx.raw_streams, details=fx.stream_details),
        min_size="100KB",
        top=10,
    )
