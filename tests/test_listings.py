"""Literal pages through the readers and listings."""

import json

import pytest
from pyspark.sql import functions as F

from metascope.operators import ordering
from metascope.sources import exports, listings, pages
from metascope.sources.schemas import DETAILS, TAG_ROWS

DAY = "2024-01-01T00:00:00Z"


@pytest.fixture
def land(spark, tmp_path):
    """Writes pages as a text file and reads their records."""

    def write(entity, *contents, folder="", **options):
        path = tmp_path / entity / folder
        path.mkdir(parents=True, exist_ok=True)
        (path / "0.json").write_text("\n".join(json.dumps(c) for c in contents))
        return pages.read_pages(spark, str(tmp_path / entity), entity, **options)

    return write


def machines(land, *names, kind="STANDARD"):
    records = [{"stateMachineArn": f"arn:{n}", "name": n, "type": kind, "creationDate": DAY} for n in names]
    return land("state_machines", {"stateMachines": records})


def tags(spark, **owned):
    rows = [(f"arn:{name}", k, v, i) for name, pairs in owned.items() for i, (k, v) in enumerate(pairs)]
    return spark.createDataFrame(rows, TAG_ROWS)


def names(df, column="name"):
    return sorted(r[column] for r in df.collect())


def test_objects(land):
    record = {"Key": "reports/may.txt", "Size": 1024, "LastModified": DAY, "StorageClass": "STANDARD"}
    other = {"Key": "other", "Size": 1, "LastModified": DAY, "ETag": '"abc"', "Owner": {"DisplayName": "me"}}
    raw = land("objects", {"Contents": [record, other]}, {"KeyCount": 0})
    assert names(listings.objects(raw, prefix="reports/"), "key") == ["reports/may.txt"]
    full = {r["key"]: r for r in listings.objects(raw, extended=True).collect()}
    assert full["other"]["storage_class"] == "STANDARD"
    assert (full["other"]["etag"], full["other"]["owner"]) == ("abc", "me")
    assert (full["reports/may.txt"]["etag"], full["reports/may.txt"]["owner"]) == ("", "")
    exported = {r["key"]: r["storage_class"] for r in exports.objects(raw).collect()}
    assert exported == {"reports/may.txt": "STANDARD", "other": None}


def test_folder_partitions_become_columns(land):
    land("objects", {"Contents": [{"Key": "a", "Size": 1, "LastModified": DAY}]}, folder="bucket=x")
    raw = land("objects", {"Contents": [{"Key": "b", "Size": 1, "LastModified": DAY}]}, folder="bucket=y")
    assert names(listings.objects(raw, bucket="y"), "key") == ["b"]


def test_nested_folders(land):
    raw = land("streams", {"StreamNames": ["a"]}, folder="2024/01", nested=True)
    assert names(raw, "StreamName") == ["a"]


def test_only_named_fields_are_parsed(land):
    record = {"Key": "a", "Size": 1, "LastModified": DAY, "ETag": "x"}
    raw = land("objects", {"Contents": [record]}, fields=["Key", "Size"])
    assert raw.collect() == [("a", 1)]
    with pytest.raises(ValueError):
        land("streams", {"StreamNames": ["a"]}, fields=["Key"])


def test_pretty_printed_pages(spark, tmp_path):
    for i, name in enumerate("ab"):
        (tmp_path / f"{i}.json").write_text(json.dumps({"StreamNames": [name]}, indent=2))
    assert names(pages.read_pages(spark, str(tmp_path), "streams", multiline=True), "StreamName") == ["a", "b"]


def test_pages_in_a_column(spark):
    text = spark.createDataFrame([('{"StreamNames": ["a", "b"]}',), ("{}",), ("broken",)], "value string")
    kept = pages.records_of(text, "streams", on_damage="skip")
    assert names(kept, "StreamName") == ["a", "b"]
    told = pages.records_of(text, "streams", on_damage="column").collect()
    assert sorted((r["StreamName"] or "", r["damaged_page"] or "") for r in told) == [("", "broken"), ("a", ""), ("b", "")]
    with pytest.raises(Exception, match="(?i)malformed"):
        pages.records_of(text, "streams").collect()


def test_jobs(land):
    job = {"Name": "etl-test-job", "Role": "role/etl", "CreatedOn": DAY, "MaxCapacity": 2.0}
    raw = land("jobs", {"Jobs": [job, {"Name": "other"}]})
    [row] = listings.jobs(raw, prefix="etl-").collect()
    assert (row["name"], row["role"], row["max_capacity"]) == ("etl-test-job", "role/etl", 2.0)
    [bare] = listings.jobs(raw, prefix="other", extended=True).collect()
    assert bare.asDict() == {
        "name": "other",
        "role": "",
        "created_on": None,
        "max_capacity": 0.0,
        "description": "",
        "command": "",
        "script_location": "",
        "max_retries": 0,
        "timeout": 0,
    }
    with pytest.raises(ValueError):
        listings.jobs(raw, status="FAILED")


def test_job_columns_of_the_last_run_only_when_asked_for(land, spark):
    raw = land("jobs", {"Jobs": [{"Name": "a"}]})
    runs = listings.all_job_runs(land("job_runs", {"JobRuns": [{"Id": "1", "JobName": "a", "JobRunState": "FAILED"}]}))
    assert "last_run_status" not in listings.jobs(raw, runs=runs).columns
    [row] = listings.jobs(raw, runs=runs, extended=True).collect()
    assert (row["last_run_status"], row["last_run_time"], row["last_run_duration"]) == ("FAILED", None, 0)


def test_streams(land):
    raw = land("streams", {"StreamNames": ["orders-live", "orders-beta", "other"]})
    assert names(listings.streams(raw, prefix="orders-")) == ["orders-beta", "orders-live"]


def test_stream_details(land, spark):
    raw = land("streams", {"StreamNames": ["full", "plain", "gone"]})
    details = spark.read.schema(DETAILS["streams"]).json(
        spark.sparkContext.parallelize(
            [
                json.dumps(d)
                for d in (
                    {
                        "StreamName": "full",
                        "StreamStatus": "ACTIVE",
                        "StreamModeDetails": {"StreamMode": "ON_DEMAND"},
                        "Shards": [{"ShardId": "1"}, {"ShardId": "2"}],
                        "EnhancedMonitoring": [{"ShardLevelMetrics": ["In"]}, {"ShardLevelMetrics": ["Out"]}],
                    },
                    {"StreamName": "full", "Shards": [{"ShardId": "3"}]},
                    {"StreamName": "plain", "StreamStatus": "ACTIVE", "Shards": [], "EnhancedMonitoring": []},
                )
            ]
        )
    )
    rows = {r["name"]: r for r in listings.streams(raw, details=details).collect()}
    assert (rows["full"]["mode"], rows["full"]["shard_count"], rows["full"]["monitoring_level"]) == ("ON_DEMAND", 3, ["In"])
    assert (rows["plain"]["mode"], rows["plain"]["shard_count"]) == ("PROVISIONED", 0)
    assert rows["plain"]["monitoring_level"] is None and rows["plain"]["error"] is None
    assert (rows["gone"]["status"], rows["gone"]["error"]) == (None, "details not found")


def test_machines_without_filter(land):
    assert names(listings.state_machines(machines(land, "A", "B"))) == ["A", "B"]


def test_machines_by_prefix(land):
    raw = machines(land, "NightlyLoad", "WeeklyLoad")
    assert names(listings.state_machines(raw, prefix="Night")) == ["NightlyLoad"]


def test_machines_by_regex(land):
    raw = machines(land, "Machine-01-Prod", "Machine-02-Dev")
    assert names(listings.state_machines(raw, regex=r"Machine-\d+-Prod")) == ["Machine-01-Prod"]


@pytest.mark.parametrize(
    ("wanted", "found"),
    [
        (["Env=Prod"], ["A", "B"]),
        (["Env=Prod", "Project=Alpha"], ["A"]),
        (["Env=Test"], []),
        (["Missing=x"], []),
        (["junk"], ["A", "B", "C", "D"]),
        ([], ["A", "B", "C", "D"]),
        (["Env = Prod"], []),
    ],
)
def test_machines_by_tags(land, spark, wanted, found):
    raw = machines(land, "A", "B", "C", "D")
    rows = tags(
        spark,
        A=[("Env", "Prod"), ("Project", "Alpha")],
        B=[("Env", "Prod"), ("Project", "Beta")],
        C=[("Env", "Prod"), ("Env", "Dev")],
    )
    assert names(listings.state_machines(raw, tags=wanted, tag_rows=rows)) == found


def test_machine_details(land, spark):
    raw = machines(land, "A", "B", "C")
    details = spark.createDataFrame(
        [("arn:A", "ACTIVE", "role/a"), ("arn:B", None, None)], "stateMachineArn string, status string, roleArn string"
    )
    rows = {r["name"]: (r["status"], r["role_arn"]) for r in listings.state_machines(raw, details=details).collect()}
    assert rows == {"A": ("ACTIVE", "role/a"), "B": ("UNKNOWN", ""), "C": ("ERROR_FETCHING_DETAILS", None)}


def test_landed_details(spark, tmp_path):
    (tmp_path / "0.json").write_text(json.dumps({"stateMachineArn": "arn:A", "status": "ACTIVE", "other": 1}))
    details = pages.read_details(spark, str(tmp_path), "state_machines")
    assert details.drop("landed_at").collect() == [("arn:A", "ACTIVE", None)]
    assert details.select("landed_at").first()[0] is not None


def test_machines_limited(land):
    raw = machines(land, "Machine1", "Machine2", "Machine3")
    first = ordering.limit(listings.state_machines(raw), 2, "name")
    assert [r["name"] for r in first.collect()] == ["Machine1", "Machine2"]


def test_catalog_tables(land):
    full = {
        "Name": "t",
        "CreateTime": DAY,
        "StorageDescriptor": {
            "Location": "s3://b/t",
            "InputFormat": "org.x.TextInput",
            "SerdeInfo": {"SerializationLibrary": "org.x.Serde"},
            "Columns": [{"Name": "a", "Type": "int"}, {"Name": "b"}],
        },
        "PartitionKeys": [{"Name": "day", "Type": "date"}],
        "Parameters": {"totalSize": "7"},
    }
    raw = land("catalog_tables", {"TableList": [full, {"Name": "bare", "TableType": "VIEW"}]})
    rows = {r["table"]: r for r in listings.catalog_tables(raw, "db", extended=True).collect()}
    t = rows["t"]
    assert (t["database"], t["type"], t["location"]) == ("db", "EXTERNAL_TABLE", "s3://b/t")
    assert (t["input_format"], t["output_format"], t["serde"]) == ("TextInput", "", "Serde")
    assert [tuple(c) for c in t["columns"]] == [("a", "int"), ("b", "")]
    assert (t["column_count"], t["partition_keys"], t["size_bytes"]) == (2, ["day"], 7)
    bare = rows["bare"]
    assert (bare["type"], bare["location"], bare["input_format"], bare["serde"]) == ("VIEW", None, None, None)
    assert (bare["column_count"], bare["partition_count"], bare["properties"], bare["size_bytes"]) == (0, 0, {}, None)


def test_ml_details(land, spark):
    raw = land(
        "training_jobs",
        {
            "TrainingJobSummaries": [
                {"TrainingJobName": "a", "TrainingJobStatus": "Completed", "CreationTime": DAY},
                {"TrainingJobName": "b", "TrainingJobStatus": "Failed", "CreationTime": DAY, "TrainingTimeInSeconds": 5},
            ]
        },
    )
    details = spark.createDataFrame([("a", ("m5", None), None)], DETAILS["training_jobs"])
    rows = {r["name"]: r for r in listings.training_jobs(raw, details=details).collect()}
    assert (rows["a"]["training_time_seconds"], rows["a"]["instance_count"], rows["a"]["role_arn"]) == (0, 0, "")
    assert (rows["b"]["training_time_seconds"], rows["b"]["instance_type"]) == (5, None)
    dropped = listings.training_jobs(raw, details=details, miss="drop")
    assert names(dropped) == ["a"]
    with pytest.raises(ValueError):
        listings.training_jobs(raw, details=details, miss="guess")


def test_name_contains_is_not_a_prefix(land):
    raw = land(
        "processing_jobs",
        {"ProcessingJobSummaries": [{"ProcessingJobName": n, "CreationTime": DAY} for n in ("x-model", "model-y")]},
    )
    assert names(listings.processing_jobs(raw, name_contains="model")) == ["model-y", "x-model"]
    assert names(listings.processing_jobs(raw, prefix="model")) == ["model-y"]


def test_stacks_by_tags(land, spark):
    raw = land("stacks", {"StackSummaries": [{"StackName": "app-a", "StackStatus": "OK"}, {"StackName": "app-b"}]})
    rows = spark.createDataFrame([("app-a", "Env", "prod", 1)], TAG_ROWS)
    assert names(listings.stacks(raw, tags=" Env = prod ", tag_rows=rows), "stack_name") == ["app-a"]
    assert names(listings.stacks(raw, statuses="OK,"), "stack_name") == ["app-a"]
    assert listings.stacks(raw, extended=True).filter(F.col("drift_information").isNotNull()).count() == 0


def test_failed_executions(land, spark):
    def execution(name, start, status="FAILED", machine="m"):
        return {"executionArn": name, "stateMachineArn": machine, "name": name, "status": status, "startDate": start}

    raw = land(
        "executions",
        {
            "executions": [
                execution("edge", "2024-01-24T00:00:00Z"),
                execution("in", "2024-01-24T00:00:00.000001Z"),
                execution("ok", "2024-01-30T00:00:00Z", status="SUCCEEDED"),
                execution("other", "2024-01-30T00:00:00Z", machine="n"),
                execution("undated", None),
            ]
        },
    )
    inputs = spark.createDataFrame([("in", None), ("other", '{"a": 1}'), ("edge", "x")], DETAILS["executions"])
    found = listings.failed_executions(raw, inputs, machine_arn="m", as_of="2024-01-31T00:00:00Z")
    assert [(r["name"], r["input"]) for r in found.collect()] == [("in", "{}")]
    assert names(listings.failed_executions(raw, inputs, as_of="2024-01-31")) == ["in", "other"]


def test_query_errors_need_a_time(land, spark):
    def query(name, state, time):
        return {"QueryExecutionId": name, "WorkGroup": "g", "Status": {"State": state, "SubmissionDateTime": time}}

    ids = land("query_ids", {"QueryExecutionIds": ["a", "b", "c", "d"]}, folder="workgroup=g")
    details = land(
        "query_executions",
        {
            "QueryExecutions": [
                query("a", "FAILED", "2024-01-24T00:00:00Z"),
                query("b", "FAILED", None),
                query("c", "SUCCEEDED", "2024-01-30T00:00:00Z"),
                query("z", "FAILED", "2024-01-30T00:00:00Z"),
            ]
        },
    )
    assert names(exports.query_errors(ids, details, "g", as_of="2024-01-31"), "query_id") == ["a"]


def test_exports_keep_missing_times(land):
    runs = [
        {"Id": "edge", "JobName": "j", "StartedOn": "2024-01-24T00:00:00Z"},
        {"Id": "old", "JobName": "j", "StartedOn": "2024-01-23T23:59:59Z"},
        {"Id": "undated", "JobName": "j"},
        {"Id": "other", "JobName": "k"},
    ]
    raw = land("job_runs", {"JobRuns": runs})
    assert names(exports.job_runs(raw, "j", as_of="2024-01-31"), "id") == ["edge", "undated"]
