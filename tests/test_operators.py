"""Filters, lookups, aggregates, ordering, unions and plans on literal rows."""

import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from metascope.operators import aggregates, filters, lookups, ordering, prefixes, unions
from metascope.operators.projection import project
from metascope.plans import actions, reports, rules
from metascope.sources import listings
from metascope.sources.schemas import TAG_ROWS

RUNS = "job_name string, id string, status string, started_on timestamp, execution_time bigint"


def named(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def names(df, column="name"):
    return sorted(r[column] for r in df.collect())


def when(text):
    return datetime.fromisoformat(text)


def runs(spark):
    return spark.createDataFrame(
        [
            ("a", "1", "FAILED", when("2024-01-01"), 5),
            ("a", "2", "SUCCEEDED", when("2024-01-02"), 6),
            ("a", "9", "RUNNING", None, 7),
            ("b", "1", "SUCCEEDED", when("2024-01-01"), 1),
            ("b", "2", "FAILED", when("2024-01-01"), None),
            ("c", "1", None, None, None),
        ],
        RUNS,
    )


# Filters


def test_no_value_is_no_filter(spark):
    df = named(spark, "a", "b", None)
    for same in (
        filters.prefix(df, "name", ""),
        filters.contains(df, "name", ""),
        filters.matches(df, "name", None),
        filters.one_of(df, "name", ""),
        filters.equals(df, "name", None),
        filters.in_range(df, "name"),
        filters.in_period(df, "name"),
    ):
        assert same is df


def test_name_filters(spark):
    df = named(spark, "prod-app", "app-prod", "PROD-x", "a.b", None)
    assert names(filters.prefix(df, "name", "prod")) == ["prod-app"]
    assert names(filters.prefix(df, "name", "%")) == []
    assert names(filters.contains(df, "name", "prod")) == ["app-prod", "prod-app"]
    assert names(filters.contains(df, "name", ".")) == ["a.b"]
    assert names(filters.matches(df, "name", "rod")) == ["app-prod", "prod-app"]
    assert names(filters.matches(df, "name", r"^(?P<e>prod)-|(?P<x>a)\.")) == ["a.b", "prod-app"]
    assert names(filters.matches(df, "name", r"(?P<c>p)(?P=c)")) == ["app-prod", "prod-app"]


def test_lists_and_inequality(spark):
    df = named(spark, "A", "B", "", "a", None)
    assert names(filters.one_of(df, "name", "A, B,")) == ["", "A", "B"]
    assert [r["name"] for r in filters.differs(df.filter("name = 'A' or name is null"), "name", "A").collect()] == [None]


def test_bounds_are_included(spark):
    df = spark.createDataFrame([(i,) for i in (1023, 1024, 2048, 2049, None)], "size bigint")
    assert names(filters.in_range(df, "size", "1KB", "2KB"), "size") == [1024, 2048]
    assert names(filters.in_range(df, "size", 0, 1023), "size") == [1023]
    times = spark.sql("select explode(array('2024-01-01', '2024-01-02', '2024-01-03')) t").selectExpr("timestamp(t) t")
    assert filters.in_period(times, "t", "2024-01-01", "2024-01-02").count() == 2
    assert filters.in_period(times, "t", "1 day ago", None, "2024-01-03").count() == 2


def test_three_lookbacks(spark):
    df = spark.sql(
        "select 'FAILED' state, explode(array(timestamp'2024-01-24 00:00:00', timestamp'2024-01-24 00:00:01', "
        "timestamp'2024-01-23 23:59:59', null)) t"
    )
    assert filters.since_or_missing(df, "t", 7, "2024-01-31").count() == 3
    assert filters.failed_since(df, "state", "t", 7, "2024-01-31").count() == 2
    assert filters.after(df, "t", 7, "2024-01-31").count() == 1


def test_parseable(spark):
    df = named(spark, "2024-01-01T00:00:00Z", "2024-01-01T02:00:00+02:00", "soon", None)
    found = filters.parseable(df, "name", "t").select(F.unix_seconds("t").alias("t"))
    assert names(found, "t") == [1704067200, 1704067200]


def test_tag_maps(spark):
    df = spark.sql("select * from values ('a', map('k', 'v', 'j', 'w')), ('b', map('k', 'x')), ('c', null) t(name, tags)")
    assert names(filters.tagged(df, "k=v,j=w")) == ["a"]
    assert names(filters.tagged(df, {"k": "x"})) == ["b"]
    assert names(filters.tagged(df, "junk")) == ["a", "b", "c"]


def test_projection(spark):
    df = named(spark, "a").withColumn("x.y", F.lit(1))
    assert project(df, " name , gone,x.y").collect()[0].asDict() == {"name": "a", "gone": "", "x.y": 1}
    assert project(df, None) is df


# Lookups


def test_latest_run(spark):
    found = {r["job_name"]: tuple(r)[1:] for r in lookups.latest_runs(runs(spark)).collect()}
    assert found["a"] == ("2", "SUCCEEDED", when("2024-01-02"), 6)
    assert found["b"] == ("2", "FAILED", when("2024-01-01"), 0)
    assert found["c"] == ("1", None, None, 0)


def test_jobs_by_last_status(spark):
    jobs = named(spark, "a", "b", "c", "never")
    assert names(lookups.jobs_with_last_run(jobs, runs(spark))) == ["a", "b", "c", "never"]
    assert names(lookups.jobs_with_last_run(jobs, runs(spark), "FAILED")) == ["b"]
    assert names(lookups.jobs_with_last_run(jobs, runs(spark), "FAILED", keep_never_run=True)) == ["b", "never"]
    assert names(actions.restart_candidates(jobs, runs(spark), "b")) == ["b"]


def test_stale_failed_jobs(spark):
    rows = [("old", "FAILED", when("2024-01-23")), ("edge", "FAILED", when("2024-01-24")), ("ok", "SUCCEEDED", when("2023-01-01"))]
    df = spark.createDataFrame(rows, "name string, last_run_status string, last_run_time timestamp")
    assert names(actions.stale_failed_jobs(df, as_of="2024-01-31")) == ["old"]


def test_gate(spark):
    tables = spark.createDataFrame([("t_1",), ("x",)], "`table` string")
    jobs = named(spark, "etl-b", "etl-a", "a")

    def gate(*rows):
        found = lookups.gated_tables(tables, jobs, spark.createDataFrame(list(rows), RUNS), "etl-", "t_")
        return names(found, "table")

    assert gate(("etl-a", "1", "SUCCEEDED", when("2024-01-01"), 1), ("etl-b", "1", "FAILED", None, 1)) == ["t_1"]
    assert gate(("etl-a", "1", "FAILED", when("2024-01-01"), 1), ("etl-b", "1", "SUCCEEDED", None, 1)) == []
    assert gate(("etl-b", "1", "SUCCEEDED", None, 1)) == []


def test_untagged(spark):
    rows = spark.createDataFrame([("a", "k", "v", 1), ("a", "j", "v", 1)], TAG_ROWS)
    assert names(lookups.untagged(named(spark, "a", "b"), "name", rows)) == ["b"]


def test_tags_last_wins(spark):
    rows = spark.createDataFrame([("a", "k", "1", 1), ("a", "k", "2", 3), ("a", "k", "3", 2), ("b", "j", None, 1)], TAG_ROWS)
    assert {r[0]: r[1] for r in aggregates.tags_as_map(rows).collect()} == {"a": {"k": "2"}, "b": {"j": None}}
    assert names(lookups.having_tags(named(spark, "a", "b"), "name", rows, "k=2")) == ["a"]
    assert names(lookups.having_tags(named(spark, "a", "b"), "name", rows, "k=3")) == []
    assert names(lookups.having_tags(named(spark, "a", "b"), "name", rows, "nothing")) == ["a", "b"]


# Prefixes and rules, against brute force


def inventory(spark, n=3000, seed=1):
    """A third of the keys lie under one prefix."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        folder = "logs/" if i % 3 == 0 else draw.choice(["data/", "dat", "d", "", "backups/2024/", "é/"])
        rows.append(("b", f"{folder}{draw.randrange(500)}-{i}", draw.randrange(5000), when(f"2024-01-{draw.randrange(1, 29):02}")))
    return rows, spark.createDataFrame(rows, "bucket string, key string, size bigint, last_modified timestamp")


PREFIXES = ["logs/", "l", "data/1", "data/", "dat", "é/", "none", "", "backups/2024/49", "x" * 99]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_counts_by_prefix(spark, broadcast):
    rows, df = inventory(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        listed = spark.createDataFrame([(p,) for p in [*PREFIXES, "logs/", None]], "prefix string")
        found = {r["prefix"]: r["n"] for r in prefixes.counts_by_prefix(df, "key", listed).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == {p: sum(r[1].startswith(p) for r in rows) for p in PREFIXES}


RULES = [
    ("all", None, None, None, None, None),
    ("sized", "logs/", "1KB", "2KB", None, None),
    ("timed", "d", None, None, "2024-01-05", "2 weeks ago"),
    ("same", "logs/", "1KB", None, None, None),
    ("bad size", "logs/", "much", None, None, None),
    ("bad time", "", None, None, None, "sometime"),
]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_rules(spark, broadcast):
    rows, df = inventory(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        table = spark.createDataFrame(
            RULES, "rule_id string, prefix string, min_size string, max_size string, newer_than string, older_than string"
        )
        found = Counter(
            (r["rule_id"], r["key"]) for r in rules.match_rules(df, table, as_of="2024-01-31").collect()
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = Counter()
    for _, key, size, time in rows:
        want[("all", key)] += 1
        want[("sized", key)] += key.startswith("logs/") and 1024 <= size <= 2048
        want[("timed", key)] += key.startswith("d") and when("2024-01-05") <= time <= when("2024-01-17")
        want[("same", key)] += key.startswith("logs/") and size >= 1024
    assert found == +want


def test_rules_of_a_bucket(spark):
    df = spark.createDataFrame(
        [("x", "k", 1, when("2024-01-01")), ("y", "k", 1, when("2024-01-01"))],
        "bucket string, key string, size bigint, last_modified timestamp",
    )
    table = spark.createDataFrame(
        [("any", "k", None), ("one", "k", "y")], "rule_id string, prefix string, bucket string"
    ).selectExpr("*", *[f"string(null) as {c}" for c in ("min_size", "max_size", "newer_than", "older_than")])
    found = rules.match_rules(df, table, "2024-01-31").select("rule_id", "bucket").collect()
    assert sorted(tuple(r) for r in found) == [("any", "x"), ("any", "y"), ("one", "y")]


def test_objects_outside_all_rules_change_nothing(spark):
    rows = [("b", f"k{i}", None if i == 5 else i, None if i == 6 else when(f"2024-01-{i + 1:02}")) for i in range(10)]
    df = spark.createDataFrame(rows, "bucket string, key string, size bigint, last_modified timestamp")
    schema = "rule_id string, prefix string, min_size string, max_size string, newer_than string, older_than string"

    def found(*table):
        matched = rules.match_rules(df, spark.createDataFrame(list(table), schema), "2024-01-31")
        return sorted((r["rule_id"], r["key"]) for r in matched.collect())

    a = ("a", "k", "2B", "4B", "2024-01-04", "2024-01-09")
    b = ("b", "k", "3B", "7B", "2024-01-01", "2024-01-08")
    assert found(a, b) == [("a", "k3"), ("a", "k4"), ("b", "k3"), ("b", "k4"), ("b", "k7")]
    assert found(a, ("c", "k", None, "0B", None, None)) == [("a", "k3"), ("a", "k4"), ("c", "k0")]
    assert [k for r, k in found(a, ("d", None, None, None, None, None)) if r == "d"] == [f"k{i}" for i in range(10)]
    assert found(("e", "k", "9B", "much", None, None)) == []


def test_no_rules(spark):
    _, df = inventory(spark, 10)
    empty = spark.createDataFrame(
        [], "rule_id string, prefix string, min_size string, max_size string, newer_than string, older_than string"
    )
    assert rules.match_rules(df, empty, "2024-01-31").count() == 0


# Aggregates


def test_empty_totals(spark):
    empty = spark.createDataFrame([], "size bigint, name string, instance_type string, training_time_seconds bigint")
    assert aggregates.total_size(empty).collect()[0][0] == 0
    assert aggregates.count_rows(empty).collect()[0][0] == 0
    assert tuple(aggregates.instance_hours(empty, "m5").collect()[0]) == (0, 0.0)


def plan_inputs(spark):
    machines = spark.createDataFrame([("wf-1", "m1"), ("wf-2", "m2"), ("x", "m3")], "name string, arn string")
    executions = spark.createDataFrame(
        [(f"e{i}", f"m{i % 3 + 1}", f"n{i}", "FAILED", when("2024-01-30")) for i in range(6)],
        "executionArn string, stateMachineArn string, name string, status string, startDate timestamp",
    )
    inputs = spark.createDataFrame(
        [(f"e{i}", text) for i, text in enumerate(['{"a": "it\'s"}', None, "x", "raw 'q'", "{}", "y"])],
        "executionArn string, input string",
    )
    return machines, executions, inputs


def test_retry_plan(spark):
    machines, executions, inputs = plan_inputs(spark)
    plan = actions.retry_plan(machines, executions, inputs, "wf-", as_of="2024-01-31")
    rows = {r["original_execution"]: r for r in plan.collect()}
    assert sorted(rows) == ["e0", "e1", "e3", "e4"] and rows["e1"]["input"] == "{}"
    retry = {r["original_execution"]: r["retry_name"] for r in actions.with_retry_names(plan, "2024-01-31T01:02:03").collect()}
    assert retry["e0"] == "retry-n0-20240131-010203"
    commands = {r["original_execution"]: r for r in actions.rerun_commands(plan).collect()}
    assert commands["e0"]["command"].endswith("""--state-machine-arn "m1" \\\n  --input '{"a":"it'\\''s"}'""")
    assert not commands["e3"]["input_is_json"] and commands["e3"]["command"].endswith("--input 'raw '\\''q'\\'''")

    listed = listings.failed_executions(executions, inputs, machine_arn="m1", as_of="2024-01-31")
    of_machine = actions.rerun_commands(listed, "execution_arn").collect()
    assert {r["original_execution"]: r["command"] for r in of_machine} == {
        e: commands[e]["command"] for e in ("e0", "e3")
    }

    attempts = spark.createDataFrame(
        [("e0", True, None), ("e1", False, "throttled"), ("e3", False, None)],
        "original_execution string, retry_started boolean, error string",
    )
    outcomes = actions.retry_outcomes(plan, attempts)
    found = {r["original_execution"]: (r["attempted"], r["retry_started"], r["error"]) for r in outcomes.collect()}
    assert found == {
        "e0": (True, True, None),
        "e1": (True, False, "throttled"),
        "e3": (True, False, "Unknown error"),
        "e4": (False, False, "Unknown error"),
    }
    few = filters.prefix(machines, "name", "wf-")
    assert aggregates.run_summary(few, outcomes).collect()[0].asDict() == {
        "machines_checked": 2,
        "failed_found": 4,
        "retried": 1,
        "failed_to_retry": 3,
    }
    dry = aggregates.run_summary(few, actions.retry_plan(machines, executions, None, "wf-", as_of="2024-01-31"))
    assert dry.collect()[0].asDict() == {"machines_checked": 2, "failed_found": 4, "would_retry": 4}
    none = aggregates.run_summary(few.limit(0), plan.limit(0))
    assert tuple(none.collect()[0]) == (0, 0, 0)


def test_failures_per_machine(spark):
    machines, executions, _ = plan_inputs(spark)
    failed = executions.select(F.col("stateMachineArn").alias("machine_arn")).filter("machine_arn <> 'm2'")
    assert {r["name"]: r["n"] for r in aggregates.failures_per_machine(machines, failed).collect()} == {"wf-1": 2, "x": 2}
    every = aggregates.failures_per_machine(machines, failed, include_none=True)
    assert {r["name"]: r["n"] for r in every.collect()} == {"wf-1": 2, "x": 2, "wf-2": 0}


# Ordering and unions


def test_newest_first_breaks_ties_by_type_then_name(spark):
    t = when("2024-01-01")
    rows = [("transform", "a", t), ("training", "b", t), ("training", "a", t), ("processing", "z", t), ("transform", "n", when("2024-01-02"))]
    df = spark.createDataFrame(rows, "type string, name string, created_time timestamp")
    found = [(r["type"], r["name"]) for r in ordering.sort_newest_first(df).collect()]
    assert found == [("transform", "n"), ("training", "a"), ("training", "b"), ("processing", "z"), ("transform", "a")]


def test_limits(spark):
    df = named(spark, "c", "a", "b")
    assert [r["name"] for r in ordering.limit(df, 2, "name").collect()] == ["a", "b"]
    assert ordering.limit(df, 0, "name").count() == ordering.limit(df, -5, "name").count() == 0
    assert [r["name"] for r in ordering.limit(df, None, "name").collect()] == ["a", "b", "c"]
    with pytest.raises(ValueError):
        ordering.limit(df, 2)


def test_pages_meet_without_gap_or_overlap(spark):
    rows = [(f"b{i % 3}", f"k{i:03}") for i in range(100)]
    df = spark.createDataFrame(rows, "bucket string, key string")
    seen, after = [], None
    while page := ordering.page(df, ["bucket", "key"], after, 7).collect():
        seen += [tuple(r) for r in page]
        after = tuple(page[-1])
    assert seen == sorted(rows)
    assert [r["key"] for r in ordering.page(df, "key", "k097").collect()] == ["k098", "k099"]


def test_union_keeps_all_columns(spark):
    a, b, c = (named(spark, "x").withColumn(k, F.lit(1)) for k in "abc")
    assert unions.ml_jobs(a, b, c).columns == ["name", "a", "b", "c"]
    assert unions.ml_jobs(a, b, c, "processing").columns == ["name", "b"]
    with pytest.raises(ValueError):
        unions.ml_jobs(a, b, c, "tuning")


def test_average_skips_types_without_seconds(spark):
    df = spark.createDataFrame(
        [("training", "s", 1), ("training", "s", 2), ("transform", "s", None)], "type string, status string, training_time_seconds int"
    )
    assert {tuple(r) for r in aggregates.by_type_and_status(df).collect()} == {("training", "s", 2, 1.5), ("transform", "s", 1, None)}


def test_cost_report(spark):
    objects = spark.createDataFrame([("a", 1024**3), ("b", 5), ("c", 2 * 1024**3)], "key string, size bigint")
    training = spark.createDataFrame([("t", 7200, "x"), ("u", 7201, "m5")], "name string, training_time_seconds bigint, instance_type string")
    streams = spark.createDataFrame([("s", 10), ("w", 11)], "name string, shard_count int")
    rows = reports.cost_report(objects, training, streams, min_size="1GB", top=1).collect()
    assert {tuple(r) for r in rows} == {
        ("large_objects", "c", None, 2.0),
        ("long_training", "u", "m5", 7201 / 3600),
        ("wide_streams", "w", None, 11.0),
    }
    rows = reports.cost_report(objects, training.drop("instance_type"), streams).collect()
    assert {r["instance_type"] for r in rows} == {None}


def test_clean_up(spark):
    t = when("2023-01-01")
    rows = [("b", "app/a", 0, t), ("b", "app/b", 1, when("2024-01-30")), ("b", "x", 0, t)]
    df = spark.createDataFrame(rows, "bucket string, key string, size bigint, last_modified timestamp")
    assert names(actions.empty_objects(df), "key") == ["app/a", "x"]
    [row] = actions.archive_candidates(df, "app/", as_of="2024-01-31").collect()
    assert tuple(row) == ("s3://b/app/a", "s3://archive/b/app/a", "GLACIER")
