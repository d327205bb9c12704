"""What Spark makes of the operators: what reaches the scan, what is shuffled, what is split."""

import re

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from metascope.fixtures import EVENTS_AS_OF, Fixtures
from metascope.operators import filters, lookups, ordering, prefixes
from metascope.plans import rules
from metascope.sources import exports, listings
from metascope.suite import QUERIES
from metascope.suite.aggregates import all_ml_jobs


def plan(df, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def pushed(df):
    """Pushed filters of all scans, in full."""
    return " ".join(re.findall(r"PushedFilters: (\[.*\])", formatted(df)))


def read_columns(df):
    """Columns read by all scans, in full."""
    return " ".join(re.findall(r"ReadSchema: (\S+)", formatted(df)))


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Landed records as Parquet."""
    fx = Fixtures(spark, f"{TESTDATA}/sf0.001")
    base = tmp_path_factory.mktemp("landed")
    records = {
        "objects": fx.raw_objects,
        "jobs": fx.raw_jobs,
        "runs": fx.raw_job_runs,
        "machines": fx.raw_state_machines,
        "tags": fx.view("resource_tags"),
        "executions": fx.raw_executions,
        "stacks": fx.raw_stacks,
        "training": fx.raw_ml_jobs("training"),
        "queries": fx.raw_queries[1],
        "ids": fx.raw_queries[0],
        "rules": fx.view("object_rules"),
        "tables": fx.raw_catalog_tables,
    }
    for name, df in records.items():
        df.write.parquet(f"{base}/{name}")
    return {name: spark.read.parquet(f"{base}/{name}") for name in records}


@pytest.fixture
def no_broadcast(spark):
    """Joins as they are made between large sides."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_object_filters_reach_the_scan(landed):
    df = listings.objects(
        landed["objects"], bucket="A", prefix="F/1", min_size="10KB", max_size="1MB", newer_than="2001-01-01", older_than="2001-06-30"
    )
    found = pushed(df)
    for part in (
        "EqualTo(bucket,A)",
        "StringStartsWith(Key,F/1)",
        "GreaterThanOrEqual(Size,10240)",
        "LessThanOrEqual(Size,1048576)",
        "GreaterThanOrEqual(LastModified,2001-01-01",
        "LessThanOrEqual(LastModified,2001-06-30",
    ):
        assert part in found


def test_lookbacks_reach_the_scan(landed):
    assert "Or(IsNull(StartedOn),GreaterThanOrEqual(StartedOn,2024-01-24" in pushed(
        exports.job_runs(landed["runs"], "a", as_of=EVENTS_AS_OF)
    )
    failures = pushed(listings.recent_failures(landed["executions"], as_of=EVENTS_AS_OF))
    assert "EqualTo(status,FAILED)" in failures and "GreaterThan(startDate,2024-01-24" in failures
    errors = pushed(exports.query_errors(landed["ids"], landed["queries"], "wg0", as_of=EVENTS_AS_OF))
    assert "EqualTo(workgroup,wg0)" in errors and "EqualTo(Status.State,FAILED)" in errors
    assert "GreaterThanOrEqual(Status.SubmissionDateTime,2024-01-24" in errors


def test_name_and_status_filters_reach_the_scan(landed):
    found = pushed(listings.stacks(landed["stacks"], prefix="b", statuses="A,B"))
    assert "StringStartsWith(StackName,b)" in found and "In(StackStatus, [A,B])" in found
    assert "StringContains(TrainingJobName,v2)" in pushed(listings.training_jobs(landed["training"], name_contains="v2"))


def test_only_asked_for_columns_are_read(landed):
    basic = read_columns(listings.objects(landed["objects"]))
    assert "ETag" not in basic and "Owner" not in basic
    assert "ETag" in read_columns(listings.objects(landed["objects"], extended=True))
    tables = read_columns(listings.catalog_tables(landed["tables"], "x"))
    assert "Location" in tables and "Columns" not in tables and "Parameters" not in tables


def test_prefix_of_jobs_reaches_their_runs(landed):
    runs = listings.all_job_runs(landed["runs"])
    assert "StringStartsWith(JobName,b)" in pushed(listings.jobs(landed["jobs"], prefix="b", status="FAILED", runs=runs))


def test_last_run_is_found_without_sorting_all_runs(landed):
    text = plan(lookups.latest_runs(listings.all_job_runs(landed["runs"])))
    assert "SortAggregate" not in text and "SortMergeJoin" not in text
    assert "HashAggregate" in text and "partial_max" in text
    # What is sorted has been looked up by its start before.
    assert text.index("Sort ") < text.index("HashJoin")


def test_regex_literals_reach_the_scan(landed):
    stacks = listings.stacks(landed["stacks"], regex="^building-(prod|dev)-.*7")
    assert "StringStartsWith(StackName,building-)" in pushed(stacks)
    assert "StringContains(StackName,-prod-)" in pushed(listings.stacks(landed["stacks"], regex="[a-z]+-prod-[0-9]"))
    assert "String" not in pushed(listings.stacks(landed["stacks"], regex="prod|dev"))


def test_rules_are_rows_not_lists(landed):
    text = plan(rules.match_rules(listings.objects(landed["objects"]), landed["rules"], "2001-11-05"))
    assert "collect_list" not in text


def test_many_rules_without_prefix(spark, no_broadcast):
    """10,000 rules that have neither bucket nor prefix: an object meets those of its cell, not all."""
    empty = F.lit(None).cast("string")
    table = spark.range(10_000).select(
        F.concat(F.lit("r"), "id").alias("rule_id"),
        empty.alias("prefix"),
        (F.col("id") * 4).cast("string").alias("min_size"),
        (F.col("id") * 4 + 3).cast("string").alias("max_size"),
        empty.alias("newer_than"),
        empty.alias("older_than"),
    )
    matched = rules.match_rules(hot_objects(spark).filter("size < 4000"), table, "2024-01-01")
    assert "NestedLoop" not in plan(matched) and "Cartesian" not in plan(matched)
    assert matched.filter("rule_id <> concat('r', size div 4)").count() == 0 and matched.count() == 4000


def test_many_rows_are_selected_not_sorted(spark):
    """Rows before the cut are kept where they are; those at it are put in range partitions."""
    df = spark.range(0, 100_000, 1, 8).select((F.col("id") * 7919 % 1000).alias("v"), "id")
    found = ordering.first_rows(df, 60_550, "v", ["id"])
    assert "Union" in plan(found) and plan(found).count("TakeOrdered") == 1
    want = sorted((i * 7919 % 1000, i) for i in range(100_000))[:60_550]
    assert sorted((r["v"], r["id"]) for r in found.collect()) == want


def test_unused_last_run_is_not_computed(landed):
    joined = lookups.jobs_with_last_run(listings.jobs(landed["jobs"]), listings.all_job_runs(landed["runs"]))
    assert "Join" not in plan(joined.select("name", "role"))


def test_tag_lookup_aggregates_by_hash(landed):
    text = plan(listings.state_machines(landed["machines"], tags=["Env=Prod", "Team=t0"], tag_rows=landed["tags"]))
    assert "SortAggregate" not in text and "partial_max" in text
    assert "In(key, [Env,Team])" in pushed(listings.state_machines(landed["machines"], tags=["Env=Prod", "Team=t0"], tag_rows=landed["tags"]))


def test_gate_is_a_subquery(landed):
    tables = listings.catalog_tables(landed["tables"], "x").select("table")
    runs = listings.all_job_runs(landed["runs"])
    text = plan(lookups.gated_tables(tables, listings.jobs(landed["jobs"]), runs, "b", "t"))
    assert "Join" not in text and "Subquery" in text
    assert "EqualTo(JobName,ScalarSubquery" in pushed(
        lookups.gated_tables(tables, listings.jobs(landed["jobs"]), runs, "b", "t")
    )


def test_top_k_is_not_a_full_sort(landed):
    assert "TakeOrderedAndProject" in plan(ordering.limit(listings.objects(landed["objects"]), 10, F.desc("size"), "key"))
    paged = ordering.page(listings.objects(landed["objects"]), ["bucket", "key"], ["A", "F/1"])
    assert "TakeOrderedAndProject" in plan(paged) and "GreaterThanOrEqual(bucket,A)" in pushed(paged)


def test_rules_are_an_equality_join(landed, no_broadcast):
    text = plan(rules.match_rules(listings.objects(landed["objects"]), landed["rules"], "2001-11-05"))
    assert "SortMergeJoin" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_bounds_shared_by_all_rules_come_before_the_cut(landed):
    text = plan(rules.match_rules(listings.objects(landed["objects"]), landed["rules"], "2001-11-05"))
    bound = re.search(r"Filter .*coalesce\(\(?Size#\d+L >= Subquery", text)
    assert bound and text.index("Generate explode") < bound.start()


@pytest.fixture
def small_skew(spark, no_broadcast):
    """Skew thresholds lowered to the size of the test data."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key in conf:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def hot_objects(spark):
    """40,000 keys in 8 files, a third of them under one prefix."""
    key = F.when(F.col("id") % 3 == 0, F.concat(F.lit("hot/"), "id")).otherwise(F.concat(F.col("id") % 997, F.lit("/"), "id"))
    return spark.range(0, 40_000, 1, 8).select(
        F.lit("b").alias("bucket"), key.alias("key"), F.col("id").alias("size"), F.current_timestamp().alias("last_modified")
    )


def listed_prefixes(spark):
    names = spark.range(1000).select(F.concat("id", F.lit("/")).alias("prefix"))
    return names.unionAll(spark.createDataFrame([("hot/",)], "prefix string"))


def check_counts(counts):
    found = {r["prefix"]: r["n"] for r in counts.collect()}
    assert found["hot/"] == 13_334 and sum(found.values()) == 40_000 and found["999/"] == 0


def test_prefixes_of_a_long_list_are_counted_before_the_join(spark, no_broadcast):
    counts = prefixes.counts_by_prefix(hot_objects(spark), "key", listed_prefixes(spark))
    text = plan(counts)
    assert "LeftSemi" not in text and "partial_count" in text
    check_counts(counts)


def test_prefixes_outside_the_list_are_dropped_before_the_shuffle(spark, tmp_path):
    listed_prefixes(spark).write.parquet(str(tmp_path / "list"))
    counts = prefixes.counts_by_prefix(hot_objects(spark), "key", spark.read.parquet(str(tmp_path / "list")))
    text = plan(counts)
    assert re.search(r"Filter .*>= Subquery", text) and text.index("partial_count") < text.index("Generate")
    check_counts(counts)


def test_prefix_sums_do_not_copy_rows_by_length(spark, no_broadcast):
    """One row per text and no more, whatever the number of lengths: nothing explodes on the side of the texts."""
    few = prefixes.sums_by_prefix(hot_objects(spark), "key", listed_prefixes(spark))
    lengths = spark.range(1, 60).select(F.expr("repeat('h', int(id))").alias("prefix")).unionAll(listed_prefixes(spark))
    many = prefixes.sums_by_prefix(hot_objects(spark), "key", lengths)

    def shape(df):
        return [plan(df).count(part) for part in ("Generate", "Exchange", "Join")]

    assert shape(few) == shape(many)
    check_counts(many.filter("prefix not like 'hh%'").filter("prefix <> 'h'"))


def test_hot_rule_is_split(spark, small_skew):
    table = spark.createDataFrame(
        [("r1", "hot/", None, None, None, None), ("r2", "5/", "1KB", None, None, None)],
        "rule_id string, prefix string, min_size string, max_size string, newer_than string, older_than string",
    )
    matched = rules.match_rules(hot_objects(spark), table, "2024-01-01")
    assert "skew=true" in plan(matched, final=True)
    assert matched.filter("rule_id = 'r1'").count() == 13_334


def test_hot_machine_is_split(spark, small_skew):
    machines = spark.range(200).select(F.concat(F.lit("m"), "id").alias("name"), F.concat(F.lit("arn"), "id").alias("arn"))
    failed = spark.range(0, 40_000, 1, 8).select(
        F.concat(F.lit("e"), "id").alias("execution_arn"),
        F.concat(F.lit("arn"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 200)).alias("machine_arn"),
    )
    joined = lookups.machines_with_failures(machines, failed)
    assert "skew=true" in plan(joined, final=True)
    assert joined.count() == 40_000


WRITES = ("src0", "snk", "str2")


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(WRITES)])
def test_no_python_and_no_pairing_of_all_rows(spark, name):
    text = plan(QUERIES[name](spark, f"{TESTDATA}/sf0.001"))
    for part in ("EvalPython", "InPandas", "InArrow", "Cartesian", "NestedLoop"):
        assert part not in text


def test_sorting_all_jobs_shuffles_once(spark):
    jobs = ordering.sort_newest_first(all_ml_jobs(Fixtures(spark, f"{TESTDATA}/sf0.001")))
    assert plan(jobs).count("Exchange") == 1


def test_filters_on_test_tables_reach_the_scan(spark):
    events = Fixtures(spark, f"{TESTDATA}/sf0.001").table("events")
    assert "GreaterThan(ts,2024-01-24" in pushed(filters.after(events, "ts", 7, EVENTS_AS_OF))
