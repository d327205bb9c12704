"""Lookups and the latest run."""

from pyspark.sql import functions as F

from ..fixtures import EVENTS_AS_OF
from ..operators import lookups
from ..operators.prefixes import counts_by_prefix, sums_by_prefix
from ..sources import listings
from .registry import LATEST, iso, query


@query(
    "win1_latest_run",
    f"""select job_name, last_run_status, {iso("last_run_time")}, last_run_duration from {LATEST} r""",
)
def _(fx):
    return lookups.latest_runs(listings.all_job_runs(fx.raw_job_runs)).drop("last_run_id")


RAN = f"""name, coalesce(role, '') as role, {iso("created_on")}, coalesce(max_capacity, 0.0) as max_capacity,
    last_run_status, {iso("last_run_time")}, last_run_duration"""


@query("jn1_jobs_with_last_run", f"select {RAN} from jobs left join {LATEST} r on name = job_name")
def jobs_with_last_run(fx):
    return lookups.jobs_with_last_run(listings.jobs(fx.raw_jobs), listings.all_job_runs(fx.raw_job_runs))


@query(
    "jn1_failed_jobs",
    f"""select {RAN} from jobs left join {LATEST} r on name = job_name
        where last_run_status = 'FAILED' and name like 'b%'""",
)
def _(fx):
    runs = listings.all_job_runs(fx.raw_job_runs)
    return listings.jobs(fx.raw_jobs, prefix="b", status="FAILED", runs=runs)


@query(
    "jn1_failed_or_never_run",
    f"""select {RAN} from jobs left join {LATEST} r on name = job_name
        where last_run_status = 'FAILED' or job_name is null""",
)
def _(fx):
    runs = listings.all_job_runs(fx.raw_job_runs)
    return listings.jobs(fx.raw_jobs, status="FAILED", runs=runs, keep_never_run=True)


def _detailed(kind: str, more: str) -> str:
    return f"""select name, status, {iso("creation_time", "created_time")}, {iso("end_time")},
        seconds as {kind}_time_seconds, '{kind}' as type, instance_type,
        case when instance_type is not null then coalesce(instance_count, 0) end as instance_count,
        case when instance_type is not null then {more} end as role_arn from ml_jobs where type = '{kind}'"""


@query("jn2_training_details", _detailed("training", "'role/' || name"))
def _(fx):
    return listings.training_jobs(fx.raw_ml_jobs("training"), details=fx.ml_details("training"))


@query("jn2_processing_details", _detailed("processing", "'role/' || name"))
def _(fx):
    return listings.processing_jobs(fx.raw_ml_jobs("processing"), details=fx.ml_details("processing"))


@query(
    "jn2_transform_details",
    f"""select name, status, {iso("creation_time", "created_time")}, {iso("end_time")},
        case when end_time is not null then want end as transform_time_seconds, 'transform' as type, instance_type,
        2 as instance_count, 'm-' || name as model_name from transform_jobs where instance_type is not null""",
)
def _(fx):
    return listings.transform_jobs(fx.raw_ml_jobs("transform"), details=fx.ml_details("transform"), miss="drop")


@query(
    "jn2_machine_details",
    f"""select name, arn, type, {iso("creation_date")},
        case when user_id % 6 = 5 then 'ERROR_FETCHING_DETAILS' when user_id % 4 = 0 then 'UNKNOWN' else 'ACTIVE' end as status,
        case when user_id % 6 <> 5 then 'role/' || name end as role_arn from state_machines""",
)
def _(fx):
    return listings.state_machines(fx.raw_state_machines, details=fx.machine_details)


@query(
    "jn2_newest_details",
    """select name, arn,
        case when user_id % 6 = 5 then 'ERROR_FETCHING_DETAILS' when user_id % 4 = 0 then 'UNKNOWN' else 'ACTIVE' end as status,
        case when user_id % 6 <> 5 then 'role/' || name end as role_arn from state_machines""",
)
def _(fx):
    """Of details that landed twice the newest count, though the older ones are greater as text."""
    machines = listings.state_machines(fx.raw_state_machines, details=fx.machine_details_twice)
    return machines.select("name", "arn", "status", "role_arn")


LAST_TAGS = """(select resource_id, key, arg_max(value, seq) as value from resource_tags group by resource_id, key)"""


@query(
    "jn3_tag_rows",
    f"""select name, arn from state_machines where arn in
        (select resource_id from {LAST_TAGS} t where (key = 'Env' and value = 'Prod') or (key = 'Team' and value = 't0')
         group by resource_id having count(*) = 2)""",
)
def _(fx):
    machines = listings.state_machines(
        fx.raw_state_machines, tags=["Env=Prod", "Team=t0"], tag_rows=fx.view("resource_tags")
    )
    return machines.select("name", "arn")


@query(
    "jn4_ids_to_details",
    f"""select query_id, workgroup, state, {iso("submission_time")} from query_executions where workgroup = 'wg1'""",
)
def _(fx):
    ids, details = fx.raw_queries
    listed = ids.filter(F.col("workgroup") == "wg1").select("QueryExecutionId")
    return lookups.with_details(listed, details, "QueryExecutionId").select(
        F.col("QueryExecutionId").alias("query_id"),
        F.col("WorkGroup").alias("workgroup"),
        F.col("Status.State").alias("state"),
        F.col("Status.SubmissionDateTime").alias("submission_time"),
    )


@query(
    "jn4_short_id_list",
    f"""select query_id, state, {iso("submission_time")} from query_executions
        where query_id in ({", ".join(f"'{7 * i}'" for i in range(25))})""",
)
def _(fx):
    found = lookups.by_ids(fx.raw_queries[1], "QueryExecutionId", [str(7 * i) for i in range(25)])
    return found.select(
        F.col("QueryExecutionId").alias("query_id"), F.col("Status.State").alias("state"), F.col("Status.SubmissionDateTime").alias("submission_time")
    )


@query(
    "jn5_machines_with_failures",
    f"""select m.name as machine_name, m.arn as machine_arn, e.execution_arn, e.name, {iso("e.start_date")},
        case when input_found then coalesce(e.input, '{{}}') end as input, input_found from state_machines m join executions e on e.machine_arn = m.arn
        where m.name like 'wf-0%' and e.status = 'FAILED' and e.start_date > timestamp '2024-01-24'""",
)
def _(fx):
    failed = listings.failed_executions(fx.raw_executions, fx.execution_inputs, as_of=EVENTS_AS_OF)
    return lookups.machines_with_failures(listings.state_machines(fx.raw_state_machines), failed, "wf-0")


def _gate(job_prefix: str) -> str:
    return f"""select table_name as "table" from catalog_tables where database = 'Brand#13' and table_name like 'red%'
        and (select last_run_status from jobs left join {LATEST} r on name = job_name
             where name like '{job_prefix}%' order by name limit 1) = 'SUCCEEDED'"""


def _gated(fx, job_prefix: str):
    tables = listings.catalog_tables(fx.raw_catalog_tables, "Brand#13").select("table")
    runs = listings.all_job_runs(fx.raw_job_runs)
    return lookups.gated_tables(tables, listings.jobs(fx.raw_jobs), runs, job_prefix, "red")


@query("jn6_gate_open", _gate("building-1"))
def _(fx):
    return _gated(fx, "building-1")


@query("jn6_gate_shut", _gate("household-11"))
def _(fx):
    return _gated(fx, "household-11")


@query(
    "jn7_counts_by_prefix",
    """select p.prefix, count(o.key) as n from prefix_list p left join objects o on starts_with(o.key, p.prefix)
        group by p.prefix""",
)
def counts_by_prefixes(fx):
    return counts_by_prefix(listings.objects(fx.raw_objects), "key", fx.view("prefix_list"))


@query(
    "jn7_sums_by_prefix",
    """select p.prefix, count(o.key) as n, cast(coalesce(sum(o.size), 0) as bigint) as bytes
        from prefix_list p left join objects o on starts_with(o.key, p.prefix) group by p.prefix""",
)
def _(fx):
    return sums_by_prefix(listings.objects(fx.raw_objects), "key", fx.view("prefix_list"), "size")


@query(
    "jn8_untagged",
    """select name, arn from state_machines where arn not in (select resource_id from resource_tags)""",
)
def _(fx):
    machines = listings.state_machines(fx.raw_state_machines)
    return lookups.untagged(machines, "arn", fx.view("resource_tags")).select("name", "arn")
