"""Large top-k, page index, prefix sums, literals of patterns, details that landed twice, the tag audit."""

import json
import os
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from metascope.functions import ranges
from metascope.functions.literals import required_literals
from metascope.operators import aggregates, filters, lookups, ordering, prefixes
from metascope.plans import rules
from metascope.sources import listings, pages


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("n", [-1, 0, 1, 57, 300, 449, 450, 451, 500, 600])
def test_first_rows(spark, n, descending):
    rng = random.Random(n)
    rows = [(rng.choice([None, -(2**63), 2**63 - 1, 5, 6, 7, rng.randrange(1000)]), rng.choice("abc"), i % 40) for i in range(500)]
    rows = [(v if v is None or i % 10 else 5, s, k) for i, (v, s, k) in enumerate(rows)]
    df = spark.createDataFrame(rows, "v long, s string, k int")

    def place(r):
        return (r[0] is None, (-r[0] if descending else r[0]) if r[0] is not None else 0, r[1], r[2])

    got = ordering.first_rows(df, n, "v", ["s", "k"], descending)
    assert sorted((tuple(r) for r in got.collect()), key=place) == sorted(rows, key=place)[: max(n, 0)]


def test_first_rows_of_other_types(spark):
    df = spark.range(1000).select(
        F.timestamp_micros(F.col("id") * 7919 % 1000 - 500).alias("t"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 100).cast("int")).alias("d"),
        (F.col("id") / 3).alias("x"),
        F.col("id").cast("string").alias("s"),
        "id",
    )
    for by, descending in (("t", True), ("d", False), ("x", True), ("s", True), ("s", False)):
        order = [F.desc(by) if descending else F.asc(by), F.asc("id")]
        want = {r["id"] for r in df.orderBy(*order).limit(333).collect()}
        assert {r["id"] for r in ordering.first_rows(df, 333, by, ["id"], descending).collect()} == want


def test_page_index(spark):
    df = spark.range(0, 2500, 1, 5).select((F.col("id") % 7).cast("string").alias("a"), (F.col("id") * 31 % 2500).alias("b"), "id")
    index = ordering.page_index(df, ["a", "b"], 100)
    want = sorted((r["a"], r["b"]) for r in df.collect())
    assert sorted(tuple(r) for r in index.collect()) == [(i, *want[i * 100]) for i in range(25)]
    pages_ = [[(r["a"], r["b"]) for r in ordering.read_page(df, index, i).collect()] for i in (0, 7, 24, 25)]
    assert pages_ == [want[:100], want[700:800], want[2400:], []]
    assert ordering.page_index(df.limit(0), "b").count() == 0
    with pytest.raises(ValueError):
        ordering.page_index(df, "b", 0)


def test_place(spark):
    rng = random.Random(3)
    rows = [(sorted(rng.randrange(30) for _ in range(n)), rng.choice([None, rng.randrange(32)])) for n in list(range(20)) * 5]
    df = spark.createDataFrame(rows, "values array<int>, v int")
    got = df.select("values", "v", ranges.place(F.col("values"), ranges.halvings(F.size("values")), F.col("v")).alias("at")).collect()
    assert all(r["at"] == (0 if r["v"] is None else sum(x <= r["v"] for x in r["values"])) for r in got)


@pytest.mark.parametrize("blocks", [1023, 3, 1])
def test_sums_by_prefix(spark, monkeypatch, blocks):
    monkeypatch.setattr(prefixes, "BLOCKS", blocks)
    rng = random.Random(blocks)
    texts = ["".join(rng.choice("ab/é\U0010ffff") for _ in range(rng.randrange(6))) for _ in range(400)] + [None]
    listed = sorted({"".join(rng.choice("ab/é\U0010ffff") for _ in range(rng.randrange(4))) for _ in range(60)}) + ["zz", None, "a", "a"]
    df = spark.createDataFrame([(t, i if i % 5 else None) for i, t in enumerate(texts)], "key string, size int")
    got = prefixes.sums_by_prefix(df, "key", spark.createDataFrame([(p,) for p in listed], "prefix string"), "size")
    want = {
        p: (
            sum(t is not None and t.startswith(p) for t in texts),
            sum(i for i, t in enumerate(texts) if i % 5 and t is not None and t.startswith(p)),
        )
        for p in listed
        if p is not None
    }
    assert {r["prefix"]: (r["n"], r["bytes"]) for r in got.collect()} == want
    empty = spark.createDataFrame([], "prefix string")
    assert prefixes.sums_by_prefix(df, "key", empty).count() == 0
    assert [tuple(r) for r in prefixes.sums_by_prefix(df.limit(0), "key", spark.createDataFrame([("a",)], "prefix string")).collect()] == [("a", 0)]


@pytest.mark.parametrize(
    "pattern,prefix,part",
    [
        ("^abc-", "abc-", "abc-"), ("abc", "", "abc"), ("^a|b", "", ""), ("a+bc", "", "bc"), ("x(?:abc)+d", "", "abc"), ("ab?cde", "", "cde"),
        ("(?i)abc", "", ""), ("^(abc)d", "abcd", "abcd"), (r"\bprod\.x", "", "prod.x"), ("a.bcd", "", "bcd"), ("[a]bc", "", "abc"), ("(abc){0,2}", "", ""),
        ("(?=abc)d", "", "d"), ("(?P<n>ab)c(?P=n)", "", "abc"), ("(?m)^abc", "", ""), ("a(?:b|c)def", "", "def"), (".*", "", ""), ("ab$", "", "ab"),
        ("(?x) a b c", "", ""), (r"\Aab", "ab", "ab"), ("(^ab)c", "", "abc"), ("x^ab", "", "xab"), ("(unclosed", "", ""),
    ],
)
def test_required_literals(pattern, prefix, part):
    assert required_literals(pattern) == (prefix, part)


@settings(max_examples=300, deadline=None)
@given(st.from_regex(r"\^?([ab](\+|\?|\*)?|\.|\(ab\)(\+|\?)?|\(a\|b\)|\[ab\]|\(?:ba\)){1,5}\$?", fullmatch=True), st.text("ab", max_size=8))
def test_literals_lose_no_match(pattern, text):
    try:
        found = re.search(pattern, text)
    except re.error:
        return
    prefix, part = required_literals(pattern)
    assert not found or (text.startswith(prefix) and part in text)


def test_regex_filter_keeps_all_matches(spark):
    df = spark.createDataFrame([("web-prod-1",), ("prod",), ("web-dev-1",), (None,)], "name string")
    for pattern, n in (("prod", 2), ("^web-", 2), ("^web-prod", 1), ("prod|dev", 3), ("(?i)PROD", 2), (r"-(\w+)-\d$", 2)):
        assert filters.matches(df, "name", pattern).count() == n


def test_latest_runs_with_ties_and_missing_starts(spark):
    rows = [
        ("a", "1", "FAILED", "2024-01-01", 1), ("a", "3", "OK", "2024-01-02", None), ("a", "2", "FAILED", "2024-01-02", 5),
        ("b", "1", "OK", None, 1), ("b", "2", None, None, 2), ("c", "1", "OK", None, 1), ("c", "0", "OK", "2024-01-01", 3), ("c", "0", "OK", "2024-01-01", 3),
    ]
    runs = spark.createDataFrame(rows, "job_name string, id string, status string, day string, execution_time long")
    runs = runs.select("job_name", "id", "status", F.to_timestamp("day").alias("started_on"), "execution_time")
    got = {r["job_name"]: (r["last_run_id"], r["last_run_status"], r["last_run_duration"]) for r in lookups.latest_runs(runs).collect()}
    assert got == {"a": ("3", "OK", 0), "b": ("2", None, 2), "c": ("0", "OK", 3)}


def test_details_that_landed_twice(spark, tmp_path):
    for number, status in ((1, "ZOMBIE"), (2, "ACTIVE")):
        path = tmp_path / f"{number}.json"
        path.write_text(json.dumps({"stateMachineArn": "m", "status": status, "roleArn": "r"}) + "\n")
        os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))
    details = pages.read_details(spark, str(tmp_path), "state_machines")
    raw = spark.createDataFrame([("m", "n", "t", None)], "stateMachineArn string, name string, type string, creationDate timestamp")
    assert [r["status"] for r in listings.state_machines(raw, details=details).collect()] == ["ACTIVE"]
    assert "landed_at" not in listings.state_machines(raw, details=details).columns


def test_damaged_details(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"stateMachineArn": "m", "status": "ACTIVE"}\n{"stateMachineArn": "broken\n{}\n')
    with pytest.raises((PySparkException, Py4JJavaError)):
        pages.read_details(spark, str(tmp_path), "state_machines").collect()
    kept = pages.read_details(spark, str(tmp_path), "state_machines", on_damage="skip")
    assert [r["stateMachineArn"] for r in kept.collect()] == ["m"] and kept.count() == 1
    told = pages.read_details(spark, str(tmp_path), "state_machines", on_damage="column").collect()
    assert sorted((r["stateMachineArn"] or "", r["damaged_page"] or "") for r in told) == [("", ""), ("", '{"stateMachineArn": "broken'), ("m", "")]
    with pytest.raises(ValueError):
        pages.read_details(spark, str(tmp_path), "state_machines", on_damage="guess")


def test_stream_pages_that_landed_twice(spark):
    rows = [("s", "UPDATING", 1, "2024-01-01"), ("s", "ACTIVE", 2, "2024-01-02")]
    details = spark.createDataFrame(
        [(n, st_, None, 24, [(str(k),)], None, None, None, at) for n, st_, k, at in rows],
        "StreamName string, StreamStatus string, StreamModeDetails struct<StreamMode:string>, RetentionPeriodHours int, Shards array<struct<ShardId:string>>, "
        "StreamCreationTimestamp timestamp, StreamARN string, EnhancedMonitoring array<struct<ShardLevelMetrics:array<string>>>, at string",
    ).withColumn("landed_at", F.to_timestamp("at"))
    got = listings.streams(spark.createDataFrame([("s",)], "StreamName string"), details=details).collect()
    assert [(r["status"], r["shard_count"]) for r in got] == [("ACTIVE", 2)]


def test_tag_audit(spark):
    resources = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "2"), ("b", "3"), ("c", None)], "service string, resource_id string")
    tags = spark.createDataFrame([("1", "k", "v"), ("3", "k", None), ("3", "j", "v")], "resource_id string, key string, value string")
    got = {r["service"]: (r["n"], r["n_untagged"]) for r in aggregates.tag_audit(resources, tags).collect()}
    assert got == {"a": (2, 1), "b": (1, 0), "c": (1, 1)}


def test_rules_with_every_kind_of_bound(spark):
    rng = random.Random(5)
    objects = spark.createDataFrame(
        [(rng.choice("xy"), rng.choice(["p/", "q/", ""]) + str(i), rng.choice([None, rng.randrange(100)]), rng.choice([None, rng.randrange(100)])) for i in range(300)],
        "bucket string, key string, size long, day int",
    ).withColumn("last_modified", F.expr("timestamp'2024-01-01' + make_dt_interval(day)"))

    def bound(unit):
        n = rng.choice([None, rng.randrange(100)])
        return None if n is None else f"{n}{unit}"

    listed = [
        (f"r{i}", rng.choice([None, "x", "y"]), rng.choice([None, "", "p/", "q/1"]), bound("B"), bound("B"), bound(" days ago"), bound(" days ago"))
        for i in range(80)
    ]
    table = spark.createDataFrame(listed, "rule_id string, bucket string, prefix string, min_size string, max_size string, newer_than string, older_than string")
    got = sorted((r["rule_id"], r["key"]) for r in rules.match_rules(objects, table, "2024-04-10").collect())
    want = []
    for o in objects.collect():
        for name, bucket, prefix, low, high, newer, older in listed:
            ok = (bucket is None or bucket == o["bucket"]) and o["key"].startswith(prefix or "")
            for text, value, sign in ((low, o["size"], 1), (high, o["size"], -1)):
                ok = ok and (text is None or (value is not None and sign * value >= sign * int(text[:-1])))
            for text, value, sign in ((newer, o["day"], 1), (older, o["day"], -1)):
                ok = ok and (text is None or (value is not None and sign * value >= sign * (100 - int(text.split()[0]))))
            if ok:
                want.append((name, o["key"]))
    assert got == sorted(want) and len(want) > 500
    assert rules.match_rules(objects, table.limit(0), "2024-04-10").count() == 0
