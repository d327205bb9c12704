"""Behaviour that whole and repeated input asks for."""

from datetime import UTC, datetime

import pytest

from metascope.functions import literals as L
from metascope.operators import filters, lookups
from metascope.plans import actions, rules
from metascope.sources import exports, listings, pages

OBJECT = "bucket string, key string, size bigint, last_modified timestamp"
RULE = "rule_id string, bucket string, prefix string, min_size string, max_size string, newer_than string, older_than string"


def objects(spark, *rows):
    return spark.createDataFrame([(b, k, s, datetime.fromisoformat(t).replace(tzinfo=UTC)) for b, k, s, t in rows], OBJECT)


def matched(spark, inventory, *rows):
    found = rules.match_rules(inventory, spark.createDataFrame(rows, RULE), "2024-01-31")
    return sorted((r["rule_id"], r["bucket"], r["key"]) for r in found.collect())


def test_no_bound_binds_nothing(spark):
    inventory = objects(spark, ("a", "logs/1", 5, "9999-12-31T12:00:00"), ("a", "logs/2", None or 0, "0001-01-02T00:00:00"))
    assert matched(spark, inventory, ("r", None, "logs/", "0B", None, None, None)) == [("r", "a", "logs/1"), ("r", "a", "logs/2")]


def test_rules_of_buckets_and_without_prefix(spark):
    inventory = objects(spark, *[(b, k, 10, "2024-01-01T00:00:00") for b in "ab" for k in ("logs/1", "tmp/1")])
    found = matched(
        spark,
        inventory,
        ("all", None, None, None, None, None, None),
        ("of_a", "a", None, None, None, None, None),
        ("logs", None, "logs/", None, None, None, None),
        ("logs_b", "b", "logs/", "10", None, None, None),
        ("big", None, None, "11", None, None, None),
    )
    every = [(b, k) for b in "ab" for k in ("logs/1", "tmp/1")]
    want = [("all", *o) for o in every] + [("of_a", *o) for o in every if o[0] == "a"]
    want += [("logs", b, "logs/1") for b in "ab"] + [("logs_b", "b", "logs/1")]
    assert found == sorted(want)


def test_thousand_buckets_with_one_prefix(spark):
    """Each object meets the rule of its own bucket only, by a join on bucket and prefix."""
    inventory = objects(spark, *[(f"b{i}", "logs/x", i, "2024-01-01T00:00:00") for i in range(1000)])
    table = spark.createDataFrame([(f"r{i}", f"b{i}", "logs/", None, None, None, None) for i in range(1000)], RULE)
    found = rules.match_rules(inventory, table, "2024-01-31")
    text = found._jdf.queryExecution().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert found.count() == 1000 and found.filter("substring(rule_id, 2) <> substring(bucket, 2)").count() == 0


def test_rejected_rules_are_told(spark):
    table = spark.createDataFrame([("x", None, "a/", "1 parsec", None, "soon", None), ("y", None, "a/", "1KB", None, None, None)], RULE)
    assert [tuple(r) for r in rules.rejected_rules(table, "2024-01-31").collect()] == [("x", "min_size,newer_than")]


def test_repeated_details_and_ids_do_not_multiply(spark):
    left = spark.createDataFrame([("a",), ("b",)], "name string")
    details = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "name string, n int")
    found = lookups.enrich(left, details, "name", {"n": details["n"]}, "null")
    assert sorted(tuple(r) for r in found.collect()) == [("a", 2), ("b", None)]
    ids = spark.createDataFrame([("a",), ("a",)], "name string")
    assert lookups.with_details(ids, details.limit(1), "name").count() == 1


def test_missing_inputs_keep_their_execution(spark):
    runs = spark.createDataFrame([("e1", "m"), ("e2", "m")], "execution_arn string, machine_arn string")
    inputs = spark.createDataFrame([("e1", None), ("e1", None)], "executionArn string, input string")
    found = listings.with_inputs(runs, inputs).select("execution_arn", "input", "input_found")
    assert sorted(tuple(r) for r in found.collect()) == [("e1", "{}", True), ("e2", None, False)]


def test_attempts_of_one_execution_are_one(spark):
    plan = spark.createDataFrame([("e1",), ("e2",)], "original_execution string")
    tries = spark.createDataFrame([("e1", False, "a"), ("e1", True, None), ("e2", False, "b")], "original_execution string, retry_started boolean, error string")
    found = actions.retry_outcomes(plan, tries).select("original_execution", "retry_started", "error")
    assert sorted(tuple(r) for r in found.collect()) == [("e1", True, None), ("e2", False, "b")]


def test_shards_that_landed_twice_count_once(spark):
    schema = (
        "StreamName string, StreamStatus string, StreamModeDetails struct<StreamMode:string>, RetentionPeriodHours int, "
        "Shards array<struct<ShardId:string>>, StreamCreationTimestamp timestamp, StreamARN string, "
        "EnhancedMonitoring array<struct<ShardLevelMetrics:array<string>>>"
    )
    page = ("s", "ACTIVE", None, 24, [("1",), ("2",)], None, "arn", None)
    details = spark.createDataFrame([page, page], schema)
    streams = spark.createDataFrame([("s",)], "StreamName string")
    assert listings.streams(streams, details=details).first()["shard_count"] == 2


def test_tags_as_landed(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"StackName": "s", "Tags": [{"Key": "Env", "Value": "a"}, {"Key": "Env", "Value": "b"}]}\n{"StackName": "none"}\n')
    found = pages.read_tags(spark, str(tmp_path), "StackName")
    assert sorted(tuple(r) for r in found.collect()) == [("s", "Env", "a", 0), ("s", "Env", "b", 1)]
    stacks = spark.createDataFrame([("s",)], "name string")
    assert lookups.having_tags(stacks, "name", found, "Env=b").count() == 1
    assert lookups.having_tags(stacks, "name", found, "Env=a").count() == 0
    unnumbered = found.withColumn("seq", found["seq"].cast("int") * None)
    assert lookups.having_tags(stacks, "name", unnumbered, "Env=b").count() == 1


def test_one_grammar_of_times(spark):
    for text in ("2 days and 3 hours ago", "20240101", "2024-01-01T06"):
        with pytest.raises(ValueError):
            L.time_bound(text, "2024-01-31")
    assert L.time_bound("2 days ago", "2024-01-31") == datetime(2024, 1, 29, tzinfo=UTC)


def test_an_empty_required_text_is_compared(spark):
    raw = spark.createDataFrame([("a",), ("",)], "JobName string")
    assert filters.equals(raw, "JobName", "").count() == 1
    assert filters.equals(raw, "JobName", None).count() == 2
    assert exports  # the exports compare their required names by this filter


def test_partitions_have_few_files_and_times_stay_whole(spark, tmp_path):
    from pyspark.sql import functions as F

    from metascope.sinks import files, tables
    from metascope.streaming import records

    rows = spark.range(0, 4000, 1, 8).select((F.col("id") % 20).alias("bucket"), "id")
    tables.save_table(rows, "few_files", path=str(tmp_path / "t"), partition_by=["bucket"])
    assert len(list((tmp_path / "t").rglob("*.parquet"))) <= 40 and spark.table("few_files").count() == 4000
    spark.sql("drop table few_files")
    timed = spark.sql("select 1 as id, named_struct('t', timestamp'2024-01-02 03:04:05.123456') as s")
    assert ".123456" in records.to_records(timed).first()["data"]
    files.write_jsonl(timed, str(tmp_path / "j"))
    assert ".123456" in spark.read.text(str(tmp_path / "j")).first()[0]
