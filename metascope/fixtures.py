"""Entities derived from the generic test tables.

``VIEWS`` is SQL that Spark and DuckDB read alike; the oracles use the same
text.  ``Fixtures`` runs it on Spark and builds the nested landed records from
its scalars.
"""

from __future__ import annotations

import re
from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.columns import iso_text

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

EVENTS_AS_OF = "2024-01-31 00:00:00"
RUNS_AS_OF = "2001-08-01 00:00:00"
OBJECTS_AS_OF = "2001-11-05 00:00:00"


def _days_back(key: str) -> str:
    return (
        f"case when {key} % 50 = 0 then null "
        f"else timestamp '2024-01-31 00:00:00' - cast({key} % 30 as int) * interval '1' day end"
    )


VIEWS: dict[str, str] = {
    "objects": """
        select l_returnflag as bucket,
          concat(l_linestatus,'/',cast(l_orderkey as string),'/',cast(l_linenumber as string),'-',
                 cast(l_partkey as string),'-',cast(l_suppkey as string)) as key,
          cast(floor(l_extendedprice) as bigint) as size, l_shipdate as last_modified,
          case when l_discount=0 then null when l_linestatus='O' then 'STANDARD_IA' else 'GLACIER' end as storage_class,
          concat('"',cast(l_partkey as string),'"') as etag,
          case when l_tax=0 then null else concat('owner-',cast(l_suppkey as string)) end as owner_name,
          concat(cast(cast(floor(l_quantity) as bigint) as string),
                 case l_linenumber % 4 when 0 then 'B' when 1 then 'KB' when 2 then 'mb' else '' end) as size_text
        from lineitem""",
    "jobs": f"""
        select concat(lower(c_mktsegment),'-',cast(c_custkey as string)) as name, c_custkey as job_id,
          case when c_custkey % 5 = 0 then null else concat('role-',cast(c_nationkey as string)) end as role,
          case when c_custkey % 10 = 0 then null else c_acctbal end as max_capacity,
          {_days_back("c_custkey")} as created_on
        from customer""",
    "job_runs": """
        select j.name as job_name, lpad(cast(o.o_orderkey as string),12,'0') as id,
          case o_orderstatus when 'F' then 'FAILED' when 'O' then 'RUNNING' else 'SUCCEEDED' end as status,
          case when o_orderkey % 97 = 0 then null else o_orderdate end as started_on,
          cast(floor(o_totalprice/100) as bigint) as execution_time
        from orders o join jobs j on o.o_custkey=j.job_id where o_orderpriority='1-URGENT'""",
    "query_executions": """
        select cast(event_id as string) as query_id, concat('wg',cast(user_id % 3 as string)) as workgroup,
          case event_type when 'error' then 'FAILED' when 'view' then 'RUNNING' else 'SUCCEEDED' end as state,
          case when event_id % 97 = 0 then null else ts end as submission_time, props as reason from events""",
    "pipeline_executions": """
        select concat('pipe-',cast(user_id % 10 as string)) as pipeline_name,
          concat('arn:pe:',cast(event_id as string)) as execution_arn,
          case event_type when 'error' then 'Failed' when 'view' then 'Executing' else 'Succeeded' end as status,
          case when event_id % 89 = 0 then null else ts end as start_time, ts as last_modified_time from events""",
    "executions": """
        select concat('arn:ex:',cast(event_id as string)) as execution_arn,
          concat('ex-',cast(event_id as string)) as name, concat('arn:sm:',cast(user_id as string)) as machine_arn,
          case event_type when 'error' then 'FAILED' when 'view' then 'RUNNING' else 'SUCCEEDED' end as status,
          ts as start_date,
          case when event_id % 13 = 0 then concat('raw ',cast(event_id as string))
               when event_id % 17 = 0 then concat('{"q": "it''s ',cast(event_id as string),'"}')
               when event_id % 19 = 0 then null else props end as input, event_id % 23 <> 0 as input_found,
          event_id % 29 = 0 as landed_twice from events""",
    "state_machines": f"""
        select distinct concat('arn:sm:',cast(user_id as string)) as arn,
          concat('wf-',lpad(cast(user_id as string),3,'0')) as name,
          case when user_id % 2 = 0 then 'STANDARD' else 'EXPRESS' end as type, user_id,
          {_days_back("user_id")} as creation_date from events""",
    "resource_tags": """
        select arn as resource_id, 'Env' as key,
          case user_id % 3 when 0 then 'Prod' when 1 then 'Dev' else 'Stage' end as value, 1 as seq
          from state_machines where user_id % 7 <> 0
        union all select arn, 'Team', concat('t',cast(user_id % 5 as string)), 1
          from state_machines where user_id % 7 <> 0
        union all select arn, 'Env', 'Dev', 2 from state_machines where user_id % 10 = 0""",
    "audit_tags": """
        select resource_id, key, value from resource_tags
        union all select concat('job/',name), 'Team', role from jobs where job_id % 3 <> 0
        union all select concat('stream/',name), 'Env', status from streams where shard_count % 2 = 0""",
    "ml_jobs": """
        select case event_type when 'click' then 'training' when 'view' then 'processing' else 'transform' end as type,
          concat('model-v',cast(user_id % 3 as string),'-',cast(event_id as string)) as name,
          case event_id % 5 when 0 then 'InProgress' when 1 then 'Completed' when 2 then 'Failed'
                            when 3 then 'Stopping' else 'Stopped' end as status,
          ts as creation_time,
          case when event_id % 5 in (1,2,4) then ts + cast(floor(value*100) as int) * interval '1' second end as end_time,
          cast(floor(value*100) as bigint) as seconds,
          case when event_id % 11 = 0 then null when user_id % 4 = 0 then 'ml.p3.2xlarge' else 'ml.m5.large' end
            as instance_type,
          case when user_id % 5 = 0 then null else cast(user_id % 5 as int) end as instance_count
        from events where event_type in ('click','view','purchase')""",
    "transform_jobs": """
        select concat('transform-',cast(event_id as string)) as name, ts as creation_time,
          case event_id % 5 when 0 then 'InProgress' when 1 then 'Completed' when 2 then 'Failed'
                            when 3 then 'Stopping' else 'Stopped' end as status,
          case when event_id % 5 = 0 then null
               else ts + cast(floor(value*100) as int) * interval '1' second + interval '0.9' second end as end_time,
          cast(floor(value*100) as bigint) as want,
          case when event_id % 11 = 0 then null when user_id % 4 = 0 then 'ml.p3.2xlarge' else 'ml.m5.large' end
            as instance_type
        from events where event_type='purchase'""",
    "stacks": f"""
        select concat(lower(c_mktsegment),'-',case c_custkey % 3 when 0 then 'prod' when 1 then 'dev' else 'stage' end,
                      '-',cast(c_custkey as string)) as stack_name, c_custkey as stack_id,
          case c_custkey % 4 when 0 then 'CREATE_COMPLETE' when 1 then 'UPDATE_COMPLETE' when 2 then 'DELETE_COMPLETE'
                             else 'ROLLBACK_COMPLETE' end as stack_status,
          concat('Env = ',case c_custkey % 3 when 0 then 'prod' when 1 then 'dev' else 'stage' end,
                 ',junk,Team=',c_mktsegment) as tag_text,
          {_days_back("c_custkey")} as creation_time
        from customer""",
    "streams": """
        select s_name as name, s_nationkey as shard_count, case when s_suppkey % 3 = 0 then null else 'ON_DEMAND' end as mode,
          case when s_suppkey % 4 = 0 then 'UPDATING' else 'ACTIVE' end as status from supplier""",
    "catalog_tables": f"""
        select p_brand as database, concat(replace(p_name,' ','_'),'_',cast(p_partkey as string)) as table_name,
          case when p_type='STANDARD' then null else p_type end as table_type,
          concat('s3://',lower(p_type),'/',cast(p_partkey as string)) as location,
          concat('org.example.io.',replace(p_name,' ','.')) as input_format,
          case when p_partkey % 3 <> 2 then cast(p_partkey*1000000 as string) end as total_size,
          case when p_partkey % 3 <> 0 then cast(p_partkey*2000000 as string) end as raw_data_size,
          p_size % 4 as partition_count, {_days_back("p_partkey")} as create_time from part""",
    "retry_attempts": """
        select concat('arn:ex:',cast(event_id as string)) as original_execution, event_id % 3 <> 0 as retry_started,
          case when event_id % 6 = 0 then 'throttled' end as error
        from events where event_type='error' and event_id % 5 <> 0""",
    "object_rules": """
        select * from (values ('r1','F/1','1KB','40KB','400 weeks ago',cast(null as string)),
          ('r2','O/2','20kb',cast(null as string),'2000-01-01','2001-01-01'),
          ('r3','F/','0B','1000',cast(null as string),'1000 days ago'),
          ('r4',cast(null as string),'103000',cast(null as string),cast(null as string),cast(null as string)),
          ('bad','F/','1 parsec',cast(null as string),cast(null as string),cast(null as string)))
          as t(rule_id,prefix,min_size,max_size,newer_than,older_than)
        union all select concat('n',cast(n_nationkey as string)), concat('O/',cast(n_nationkey as string)), '1.5KB',
          concat(cast(n_nationkey + 10 as string),'KB'), '200 weeks ago', '2001-06-01T12:00:00' from nation""",
    "all_objects": """
        select bucket, key, case when storage_class is null then 0 else size end as size,
          case when size % 1000 = 0 then timestamp '9999-12-31 12:00:00' else last_modified end as last_modified from objects""",
    "bucket_rules": """
        select concat('b',cast(n_nationkey as string)) as rule_id,
          case n_nationkey % 4 when 0 then 'A' when 1 then 'N' when 2 then 'R' end as bucket,
          case n_nationkey % 3 when 0 then 'F/' when 1 then concat('O/',cast(n_nationkey as string)) end as prefix,
          concat(cast(90 + n_nationkey as string),'KB') as min_size, cast(null as string) as max_size,
          case when n_nationkey % 2 = 0 then '1995-01-01' end as newer_than, cast(null as string) as older_than
        from nation""",
    "size_rules": """
        select concat('c',cast(c_custkey as string)) as rule_id, cast(null as string) as prefix,
          case when c_custkey % 11 = 0 then concat(cast(c_custkey % 90 as string),' parsecs') else cast(900 + c_custkey * 61 % 95000 as string) end as min_size,
          case when c_custkey % 13 = 0 then 'big' when c_custkey % 4 = 0 then concat(cast(1 + c_custkey % 90 as string),'KB')
               else cast(1000 + c_custkey * 61 % 95000 as string) end as max_size,
          case when c_custkey % 17 = 0 then 'yesterday' when c_custkey % 3 = 0 then concat(cast(10 + c_custkey % 400 as string),' weeks ago') end as newer_than,
          case when c_custkey % 5 = 0 then concat(cast(c_custkey % 300 as string),' days ago') end as older_than
        from customer""",
    "tag_lists": """
        select name, user_id % 7 <> 0 as tagged, arn,
          case user_id % 3 when 0 then 'Prod' when 1 then 'Dev' else 'Stage' end as env, user_id % 10 = 0 as again from state_machines""",
    "prefix_list": """
        select distinct concat(case when o_custkey % 2 = 0 then 'F' else 'O' end,'/',
          substring(cast(o_orderkey as string),1,cast(1 + o_custkey % 3 as int))) as prefix from orders
        union select 'F/' union select 'none/'""",
    "person_source": """
        select c.c_custkey as id, c.c_name as name, n.n_name as city, r.r_name as region, c.c_mktsegment as occupation
        from customer c join nation n on c.c_nationkey=n.n_nationkey join region r on n.n_regionkey=r.r_regionkey""",
    "time_texts": """
        select o_orderkey as id, case o_orderkey % 8
          when 0 then concat(cast(o_custkey % 50 as string),' minutes ago') when 1 then '1 hour ago'
          when 2 then concat(cast(o_custkey % 9 as string),' DAYS ago') when 3 then '2 weeks ago'
          when 4 then substring(cast(o_orderdate as string),1,10) when 5 then 'yesterday'
          when 6 then concat(substring(cast(o_orderdate as string),1,10),'T06:30:00Z') else null end as text
        from orders""",
}


def _needed(sql: str, seen: list[str]) -> list[str]:
    """Names of the views that ``sql`` reads, each after the views it reads itself."""
    for name in re.findall(r"\b(?:from|join)\s+(\w+)", sql):
        if name in VIEWS and name not in seen:
            _needed(VIEWS[name], seen)
            seen.append(name)
    return seen


def with_views(sql: str) -> str:
    """``sql`` with the views it reads in front of it."""
    names = _needed(sql, [])
    return ("with " + ", ".join(f"{n} as ({VIEWS[n]})" for n in names) + " " + sql) if names else sql


@cache
def _schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema of a test table, with instants for its times; looked up once per session."""
    return T.StructType(
        [
            T.StructField(f.name, T.TimestampType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType)
            for f in spark.read.parquet(path).schema
        ]
    )


class Fixtures:
    """Views and landed records over the tables in one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A test table whose times are read as instants, so filters on them reach the scan."""
        if name not in self._tables:
            path = f"{self.sf_dir}/{name}.parquet"
            self._tables[name] = self.spark.read.schema(_schema(self.spark, path)).parquet(path)
        return self._tables[name]

    def sql(self, text: str) -> DataFrame:
        """The result of SQL over views and tables."""
        text = with_views(text)
        used = [t for t in TABLES if re.search(rf"\b(from|join)\s+{t}\b", text)]
        text = text.replace("{", "{{").replace("}", "}}")
        text = re.sub(rf"\b(from|join)(\s+)({'|'.join(TABLES)})\b", r"\1\2{\3}", text)
        return self.spark.sql(text, **{t: self.table(t) for t in used})

    def view(self, name: str) -> DataFrame:
        return self.sql(f"select * from {name}")

    @staticmethod
    def out(df: DataFrame) -> DataFrame:
        """The result as scalars: times as ISO text, nested values as JSON."""

        def scalar(field: T.StructField) -> Column:
            if isinstance(field.dataType, T.TimestampType):
                return iso_text(field.name).alias(field.name)
            if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
                return F.to_json(field.name).alias(field.name)
            return F.col(field.name)

        return df.select(*[scalar(f) for f in df.schema])

    # Landed records.

    @cached_property
    def raw_objects(self) -> DataFrame:
        return self.view("objects").select(
            "bucket",
            F.col("key").alias("Key"),
            F.col("size").alias("Size"),
            F.col("last_modified").alias("LastModified"),
            F.col("storage_class").alias("StorageClass"),
            F.col("etag").alias("ETag"),
            F.when(F.col("owner_name").isNotNull(), F.struct(F.col("owner_name").alias("DisplayName"))).alias("Owner"),
        )

    @cached_property
    def raw_jobs(self) -> DataFrame:
        command = F.struct(
            F.concat(F.lit("etl-"), "role").alias("Name"),
            F.when(F.col("job_id") % 3 != 0, F.concat(F.lit("s3://scripts/"), "name")).alias("ScriptLocation"),
        )
        return self.view("jobs").select(
            F.col("name").alias("Name"),
            F.col("role").alias("Role"),
            F.col("created_on").alias("CreatedOn"),
            F.col("created_on").alias("LastModifiedOn"),
            F.col("max_capacity").alias("MaxCapacity"),
            F.lit(None).cast("string").alias("Description"),
            F.when(F.col("role").isNotNull(), command).alias("Command"),
            F.when(F.col("job_id") % 4 != 0, (F.col("job_id") % 4).cast("int")).alias("MaxRetries"),
            F.lit(60).alias("Timeout"),
        )

    @cached_property
    def raw_job_runs(self) -> DataFrame:
        return self.view("job_runs").select(
            F.col("id").alias("Id"),
            F.col("job_name").alias("JobName"),
            F.col("status").alias("JobRunState"),
            F.col("started_on").alias("StartedOn"),
            F.lit(None).cast("timestamp").alias("CompletedOn"),
            F.col("execution_time").alias("ExecutionTime"),
        )

    @cached_property
    def raw_queries(self) -> tuple[DataFrame, DataFrame]:
        """Listed ids by workgroup, and their details."""
        queries = self.view("query_executions").withColumnRenamed("query_id", "QueryExecutionId")
        status = F.struct(
            F.col("state").alias("State"),
            F.col("submission_time").alias("SubmissionDateTime"),
            F.col("reason").alias("StateChangeReason"),
        )
        return (
            queries.select("workgroup", "QueryExecutionId"),
            queries.select("QueryExecutionId", F.col("workgroup").alias("WorkGroup"), status.alias("Status")),
        )

    @cached_property
    def raw_pipeline_executions(self) -> DataFrame:
        return self.view("pipeline_executions").select(
            "pipeline_name",
            F.col("execution_arn").alias("PipelineExecutionArn"),
            F.col("status").alias("PipelineExecutionStatus"),
            F.col("start_time").alias("StartTime"),
            F.col("last_modified_time").alias("LastModifiedTime"),
        )

    def raw_ml_jobs(self, kind: str) -> DataFrame:
        field = kind.capitalize()
        if kind == "transform":
            rows, seconds = self.view("transform_jobs"), []
        else:
            rows = self.sql(f"select * from ml_jobs where type = '{kind}'")
            seconds = [F.col("seconds").alias(f"{field}TimeInSeconds")]
        return rows.select(
            F.col("name").alias(f"{field}JobName"),
            F.col("status").alias(f"{field}JobStatus"),
            F.col("creation_time").alias("CreationTime"),
            F.col("end_time").alias(f"{field}EndTime"),
            *seconds,
        )

    def ml_details(self, kind: str) -> DataFrame:
        """Details of the jobs whose instance type is known."""
        field = kind.capitalize()
        if kind == "transform":
            rows = self.sql("select * from transform_jobs where instance_type is not null")
            resources = F.struct(F.col("instance_type").alias("InstanceType"), F.lit(2).alias("InstanceCount"))
            return rows.select(
                F.col("name").alias("TransformJobName"),
                resources.alias("TransformResources"),
                F.concat(F.lit("m-"), "name").alias("ModelName"),
            )
        rows = self.sql(f"select * from ml_jobs where type = '{kind}' and instance_type is not null")
        resources = F.struct(
            F.col("instance_type").alias("InstanceType"), F.col("instance_count").alias("InstanceCount")
        )
        if kind == "training":
            resources = resources.alias("ResourceConfig")
        else:
            resources = F.struct(resources.alias("ClusterConfig")).alias("ProcessingResources")
        return rows.select(
            F.col("name").alias(f"{field}JobName"), resources, F.concat(F.lit("role/"), "name").alias("RoleArn")
        )

    @cached_property
    def raw_stacks(self) -> DataFrame:
        gone = F.col("stack_status") == "DELETE_COMPLETE"
        return self.view("stacks").select(
            F.col("stack_name").alias("StackName"),
            F.col("stack_id").cast("string").alias("StackId"),
            F.col("creation_time").alias("CreationTime"),
            F.lit(None).cast("timestamp").alias("LastUpdatedTime"),
            F.when(gone, F.col("creation_time")).alias("DeletionTime"),
            F.col("stack_status").alias("StackStatus"),
            F.when(gone, F.lit("gone")).alias("StackStatusReason"),
            F.lit(None).cast("string").alias("TemplateDescription"),
            F.struct(
                F.lit("IN_SYNC").alias("StackDriftStatus"), F.lit(None).cast("timestamp").alias("LastCheckTimestamp")
            ).alias("DriftInformation"),
        )

    @cached_property
    def raw_streams(self) -> DataFrame:
        return self.view("streams").select(F.col("name").alias("StreamName"))

    @cached_property
    def stream_details(self) -> DataFrame:
        """Pages of at most ten shards; streams with ``shard_count % 5 = 4`` have none."""
        shards = F.when(F.col("shard_count") > 0, F.sequence(F.lit(1), F.col("shard_count"))).otherwise(F.array())
        shard_ids = F.transform(shards, lambda n: F.struct(n.cast("string").alias("ShardId")))
        metrics = F.struct(F.array(F.lit("IncomingBytes"), F.lit("OutgoingBytes")).alias("ShardLevelMetrics"))
        first = F.explode(F.sequence(F.lit(0), F.greatest(F.col("shard_count") - 1, F.lit(0)), F.lit(10)))
        rows = self.view("streams").filter(F.col("shard_count") % 5 != 4)
        return rows.withColumn("first", first).select(
            F.col("name").alias("StreamName"),
            F.col("status").alias("StreamStatus"),
            F.struct(F.col("mode").alias("StreamMode")).alias("StreamModeDetails"),
            F.lit(24).alias("RetentionPeriodHours"),
            F.slice(shard_ids, F.col("first") + 1, F.lit(10)).alias("Shards"),
            F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias("StreamCreationTimestamp"),
            F.concat(F.lit("arn:st:"), "name").alias("StreamARN"),
            F.when(F.col("shard_count") % 3 != 0, F.array(metrics)).alias("EnhancedMonitoring"),
        )

    @cached_property
    def raw_state_machines(self) -> DataFrame:
        return self.view("state_machines").select(
            F.col("arn").alias("stateMachineArn"), "name", "type", F.col("creation_date").alias("creationDate")
        )

    @cached_property
    def machine_details(self) -> DataFrame:
        return self.sql("select * from state_machines where user_id % 6 <> 5").select(
            F.col("arn").alias("stateMachineArn"),
            F.when(F.col("user_id") % 4 != 0, F.lit("ACTIVE")).alias("status"),
            F.concat(F.lit("role/"), "name").alias("roleArn"),
        )

    @cached_property
    def machine_details_twice(self) -> DataFrame:
        """Details that landed on two days: the first time all were being deleted."""
        first = self.machine_details.select("stateMachineArn", F.lit("DELETING").alias("status"), F.lit("role/old").alias("roleArn"))
        days = [F.to_timestamp(F.lit(f"2024-01-0{d} 00:00:00")).alias("landed_at") for d in (1, 2)]
        return first.select("*", days[0]).unionByName(self.machine_details.select("*", days[1]))

    @cached_property
    def raw_executions(self) -> DataFrame:
        return self.view("executions").select(
            F.col("execution_arn").alias("executionArn"),
            F.col("machine_arn").alias("stateMachineArn"),
            "name",
            "status",
            F.col("start_date").alias("startDate"),
        )

    @cached_property
    def execution_inputs(self) -> DataFrame:
        """Inputs of most executions; some landed twice."""
        landed = self.view("executions").filter("input_found")
        both = landed.unionByName(landed.filter("landed_twice"))
        return both.select(F.col("execution_arn").alias("executionArn"), "input")

    @cached_property
    def raw_catalog_tables(self) -> DataFrame:
        def keys(n: Column) -> Column:
            ids = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array())
            return F.transform(
                ids,
                lambda i: F.struct(
                    F.concat(F.lit("k"), i.cast("string")).alias("Name"),
                    F.when(i % 2 == 0, F.lit("string")).alias("Type"),
                ),
            )

        def entry(key: str, value: str) -> Column:
            return F.struct(F.lit(key).alias("key"), F.col(value).alias("value"))

        properties = F.map_from_entries(
            F.filter(
                F.array(entry("totalSize", "total_size"), entry("rawDataSize", "raw_data_size")),
                lambda e: e["value"].isNotNull(),
            )
        )
        storage = F.struct(
            F.col("location").alias("Location"),
            F.col("input_format").alias("InputFormat"),
            F.lit(None).cast("string").alias("OutputFormat"),
            F.struct(F.lit("org.example.serde.Lazy").alias("SerializationLibrary")).alias("SerdeInfo"),
            keys(F.col("partition_count") + 1).alias("Columns"),
        )
        return self.view("catalog_tables").select(
            "database",
            F.col("table_name").alias("Name"),
            F.col("table_type").alias("TableType"),
            F.col("create_time").alias("CreateTime"),
            F.lit(None).cast("timestamp").alias("UpdateTime"),
            F.lit(None).cast("timestamp").alias("LastAccessTime"),
            storage.alias("StorageDescriptor"),
            keys(F.col("partition_count")).alias("PartitionKeys"),
            properties.alias("Parameters"),
        )
