"""Sorting, top-k and paging."""

from pyspark.sql import functions as F

from ..fixtures import EVENTS_AS_OF
from ..operators import ordering
from ..sources import exports, listings
from .aggregates import ALL_ML, all_ml_jobs
from .registry import iso, query

NEWEST = """order by creation_time desc, case type when 'training' then 0 when 'processing' then 1 else 2 end, name"""


@query("srt1_newest_first", f"select type, name, {iso('creation_time', 'created_time')} from {ALL_ML} j {NEWEST}")
def _(fx):
    return ordering.sort_newest_first(all_ml_jobs(fx)).select("type", "name", "created_time")


@query(
    "srt2_export_order",
    f"""select name as training_job_name, {iso("creation_time")} from ml_jobs where type = 'training'
        and creation_time >= timestamp '2024-01-01' order by creation_time desc, name""",
)
def _(fx):
    jobs = exports.training_jobs(fx.raw_ml_jobs("training"), days=30, as_of=EVENTS_AS_OF)
    return jobs.select("training_job_name", "creation_time")


@query("lim1_limit", "select name, arn from state_machines where name like 'wf-%' order by name limit 20")
def _(fx):
    return ordering.limit(listings.state_machines(fx.raw_state_machines, prefix="wf-"), 20, "name").select("name", "arn")


@query("lim2_top", f"select type, name, {iso('creation_time', 'created_time')} from {ALL_ML} j {NEWEST} limit 50")
def top_newest(fx):
    jobs = all_ml_jobs(fx)
    return ordering.limit(jobs, 50, *ordering.newest_first(jobs)).select("type", "name", "created_time")


@query(
    "lim3_page",
    "select key, size from objects where bucket = 'N' and key > 'O/2' order by key limit 1000",
)
def _(fx):
    return ordering.page(listings.objects(fx.raw_objects, bucket="N"), "key", "O/2").select("key", "size")


@query(
    "lim3_page_two_keys",
    """select bucket, key from objects where bucket > 'N' or (bucket = 'N' and key > 'O/9') order by bucket, key limit 500""",
)
def _(fx):
    return ordering.page(listings.objects(fx.raw_objects), ["bucket", "key"], ["N", "O/9"], 500).select("bucket", "key")


@query(
    "lim2_largest_objects",
    "select key, size from objects order by size desc, key limit 10",
)
def _(fx):
    return ordering.limit(listings.objects(fx.raw_objects), 10, F.desc("size"), "key").select("key", "size")


@query(
    "lim1_many_newest",
    """select bucket, key, size from objects order by last_modified desc, bucket, key limit 25000""",
)
def _(fx):
    """More rows than one task should hold, with many ties at the cut."""
    rows = listings.objects(fx.raw_objects).select("bucket", "key", "size", "last_modified")
    return ordering.first_rows(rows, 25_000, "last_modified", ["bucket", "key"], descending=True).drop("last_modified")


@query(
    "lim1_first_names",
    """select bucket, key from objects order by key, bucket limit 7777""",
)
def _(fx):
    return ordering.first_rows(listings.objects(fx.raw_objects).select("bucket", "key"), 7777, "key", ["bucket"])


@query(
    "lim3_page_index",
    """select cast((r - 1) // 1000 as bigint) as page, bucket, key from
        (select bucket, key, row_number() over (order by bucket, key) as r from objects) t where (r - 1) % 1000 = 0""",
)
def _(fx):
    return ordering.page_index(listings.objects(fx.raw_objects), ["bucket", "key"])


@query(
    "lim3_read_page",
    """select bucket, key, size from objects order by bucket, key limit 100 offset 700""",
)
def _(fx):
    objects = listings.objects(fx.raw_objects)
    index = ordering.page_index(objects, ["bucket", "key"], 100)
    return ordering.read_page(objects, index, 7).select("bucket", "key", "size")
