"""Scalar functions."""

from pyspark.sql import functions as F

from ..fixtures import RUNS_AS_OF
from ..functions import columns as C
from ..plans import reports
from ..sources import listings
from .registry import compact, iso, query, size_of, time_of


@query("sc1_size_text", f"select bucket, key, size_text, {size_of('size_text')} as bytes from objects")
def _(fx):
    return fx.view("objects").select("bucket", "key", "size_text", C.size_bytes("size_text").alias("bytes"))


@query(
    "sc2_time_text",
    f"select id, {iso('ts')} from (select id, {time_of('text', RUNS_AS_OF)} as ts from time_texts) t",
)
def _(fx):
    return fx.view("time_texts").select("id", C.time_bound("text", RUNS_AS_OF).alias("ts"))


@query(
    "sc3_tag_text",
    """select stack_name, trim(regexp_extract(tag_text, 'Env =([^,]*)', 1)) as env,
        regexp_extract(tag_text, 'Team=([^,]*)', 1) as team, 2 as n from stacks""",
)
def _(fx):
    tags = C.tag_map("tag_text")
    return fx.view("stacks").select(
        "stack_name", tags["Env"].alias("env"), tags["Team"].alias("team"), F.size(tags).alias("n")
    )


@query("sc4_iso_text", f"select event_id, {iso('ts', 'text')}, true as same from events")
def _(fx):
    text = C.iso_text("ts")
    return fx.table("events").select(
        "event_id", text.alias("text"), (C.iso_parse(text) == F.col("ts")).alias("same")
    )


@query(
    "sc5_last_segment",
    """select table_name, list_last(string_split(input_format, '.')) as format, '' as missing from catalog_tables""",
)
def _(fx):
    return fx.view("catalog_tables").select(
        "table_name",
        C.last_segment("input_format").alias("format"),
        C.last_segment(F.lit(None).cast("string")).alias("missing"),
    )


@query("sc6_unquoted_etag", """select key, trim(etag, '"') as etag from objects""")
def _(fx):
    return fx.view("objects").select("key", C.unquote("etag").alias("etag"))


@query(
    "sc7_whole_seconds",
    "select name, case when end_time is not null then want end as seconds from transform_jobs",
)
def _(fx):
    return fx.view("transform_jobs").select("name", C.whole_seconds("creation_time", "end_time").alias("seconds"))


@query(
    "sc8_table_size",
    "select table_name, cast(coalesce(total_size, raw_data_size) as bigint) as size_bytes from catalog_tables",
)
def _(fx):
    return fx.raw_catalog_tables.select(
        F.col("Name").alias("table_name"), C.table_size("Parameters").alias("size_bytes")
    )


@query(
    "sc9_columns_of_tables",
    """select table_name, list_aggregate(list_transform(range(1, partition_count + 2),
          lambda i: 'k' || i || ':' || case when i % 2 = 0 then 'string' else '' end), 'string_agg', ',') as columns,
        coalesce(list_aggregate(list_transform(range(1, partition_count + 1), lambda i: 'k' || i), 'string_agg', ','), '')
          as partition_keys from catalog_tables""",
)
def _(fx):
    pairs = F.transform(
        C.named_types("StorageDescriptor.Columns"), lambda c: F.concat(c["name"], F.lit(":"), c["type"])
    )
    return fx.raw_catalog_tables.select(
        F.col("Name").alias("table_name"),
        F.array_join(pairs, ",").alias("columns"),
        F.array_join(C.names_of("PartitionKeys"), ",").alias("partition_keys"),
    )


@query(
    "sc10_first_element",
    "select name, case when shard_count % 3 <> 0 then 'IncomingBytes' end as metric from streams where shard_count % 5 <> 4",
)
def _(fx):
    first = C.first_element("EnhancedMonitoring")["ShardLevelMetrics"]
    metrics = fx.stream_details.select(F.col("StreamName").alias("name"), C.first_element(first).alias("metric"))
    return metrics.groupBy("name").agg(F.max("metric").alias("metric"))


@query(
    "sc11_json_text",
    f"""select execution_arn, json_valid(coalesce(input, '{{}}')) as valid,
        case when input is null then '{{}}' when json_valid(input) then {compact("input")} else input end as text
        from executions""",
)
def _(fx):
    return fx.view("executions").select("execution_arn", C.is_json("input").alias("valid"), C.json_text("input").alias("text"))


@query(
    "sc12_units",
    """select table_name as "table", cast(coalesce(total_size, raw_data_size) as bigint) / 1073741824 as size_gb
        from catalog_tables where cast(coalesce(total_size, raw_data_size) as bigint) > 1073741824""",
)
def _(fx):
    tables = fx.raw_catalog_tables.select(F.col("Name").alias("table"), C.table_size("Parameters").alias("size_bytes"))
    return reports.large_tables(tables)


@query("sc12_hours", "select name, seconds / 3600 as hours from ml_jobs where type = 'training'")
def _(fx):
    jobs = listings.training_jobs(fx.raw_ml_jobs("training"))
    return jobs.select("name", C.hours("training_time_seconds").alias("hours"))


@query("sc13_first_token", "select name, split_part(name, '-', 1) as token from jobs")
def _(fx):
    return fx.view("jobs").select("name", C.first_token("name").alias("token"))
