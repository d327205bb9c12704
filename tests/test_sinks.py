import csv
import io
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from metascope.session import tune, work_dir
from metascope.sinks import files, tables
from metascope.streaming import records


@pytest.fixture(scope="module")
def rows(spark):
    return spark.sql(
        """select * from values
           (1, 'plain', timestamp'2024-01-01 00:00:00', array(1, 2), map('k', 'v')),
           (2, 'a "b", c', null, null, null),
           (3, ' pad ', timestamp'2024-01-01 00:00:00.5', array(), map())
           as t(id, name, at, list, tags)"""
    ).repartition(3, "id")


def parts(path):
    """Contents of the files of a folder, put together in name order."""
    return "".join(p.read_text() for p in sorted(Path(path).glob("part-*")))


def test_jsonl(rows, tmp_path):
    files.write_jsonl(rows, str(tmp_path / "a"))
    found = {r["id"]: r for r in map(json.loads, parts(tmp_path / "a").splitlines())}
    assert found[1] == {"id": 1, "name": "plain", "at": "2024-01-01T00:00:00+00:00", "list": [1, 2], "tags": {"k": "v"}}
    assert found[2] == {"id": 2, "name": 'a "b", c'}
    assert found[3]["at"] == "2024-01-01T00:00:00.500000+00:00"
    files.write_jsonl(rows, str(tmp_path / "b"), "id,at", keep_nulls=True)
    assert {"id": 2, "at": None} in [json.loads(line) for line in parts(tmp_path / "b").splitlines()]


def test_tsv(rows, tmp_path):
    files.write_tsv(rows, str(tmp_path / "a"), "id,name,at,gone")
    lines = parts(tmp_path / "a").splitlines()
    assert lines[0] == "id\tname\tat\tgone"
    assert sorted(lines[1:]) == ["1\tplain\t2024-01-01T00:00:00+00:00\t", '2\ta "b", c\t\t', "3\t pad \t2024-01-01T00:00:00.500000+00:00\t"]
    files.write_tsv(rows, str(tmp_path / "b"), header=False)
    assert len(parts(tmp_path / "b").splitlines()) == 3
    files.write_tsv(rows.limit(0), str(tmp_path / "c"))
    assert parts(tmp_path / "c") == "id\tname\tat\tlist\ttags\n"


def test_csv(rows, tmp_path):
    files.write_csv(rows.coalesce(1), str(tmp_path / "a"))
    found = {r["id"]: r for r in csv.DictReader(io.StringIO(parts(tmp_path / "a")))}
    assert found["1"] == {"id": "1", "name": "plain", "at": "2024-01-01T00:00:00+00:00", "list": "[1,2]", "tags": '{"k":"v"}'}
    assert found["2"] == {"id": "2", "name": 'a "b", c', "at": "", "list": "", "tags": ""}
    assert found["3"]["name"] == " pad "
    files.write_csv(rows.coalesce(1), str(tmp_path / "b"), "name", header=False)
    assert sorted(r[0] for r in csv.reader(io.StringIO(parts(tmp_path / "b")))) == [" pad ", 'a "b", c', "plain"]


def test_table_is_replaced(spark, rows):
    tables.save_table(rows, "kept")
    assert tables.save_table(rows.filter("id = 1").select("id"), "kept").collect() == [(1,)]
    spark.sql("drop table kept")


def test_empty_table_keeps_its_columns(spark, rows):
    assert tables.save_table(rows.limit(0), "nothing").columns == rows.columns
    spark.sql("drop table nothing")


@pytest.mark.parametrize("name", ["a-b", "1a", "é", "a b", "a;drop table x", "", "a.b"])
def test_table_names(rows, name):
    with pytest.raises(ValueError):
        tables.save_table(rows, name)


def test_bucketed_tables_join_without_shuffle(spark):
    from metascope.sources.listings import with_inputs

    ids = spark.range(100).select(F.concat(F.lit("e"), "id").alias("execution_arn"))
    executions = tables.save_table(ids, "bucketed_executions", bucket_by=(4, "execution_arn"))
    texts = ids.select(F.col("execution_arn").alias("executionArn"), F.lit("{}").alias("input"))
    inputs = tables.save_table(texts, "bucketed_inputs", bucket_by=(4, "executionArn"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = with_inputs(executions, inputs)
    assert joined.count() == 100
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in ("bucketed_executions", "bucketed_inputs"):
        spark.sql(f"drop table {name}")


def test_clustered_table_splits_a_hot_bucket(spark):
    key = F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 5, "0"))
    bucket = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("b"), F.col("id") % 50))
    df = spark.range(9000).select(bucket.alias("bucket"), key.alias("key"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    saved = tables.save_table(df, "clustered", partition_by=["bucket"], cluster_by=["bucket", "key"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = saved.filter("bucket = 'hot'").groupBy(F.input_file_name().alias("f")).agg(F.min("key"), F.max("key"), F.count("*"))
    files = sorted(tuple(r)[1:] for r in hot.collect())
    assert len(files) > 1 and sum(f[2] for f in files) == 3000
    assert all(a[1] < b[0] for a, b in zip(files, files[1:]))
    spark.sql("drop table clustered")


def test_export_under_default_name(spark):
    raw = spark.createDataFrame([("a", None, None, None, 1.0)], "Name string, Role string, CreatedOn timestamp, LastModifiedOn timestamp, MaxCapacity double")
    assert tables.export(spark, "glue-jobs", raw).count() == 1
    assert spark.table("glue_jobs").columns == ["name", "role", "created_on", "last_modified_on", "max_capacity"]
    assert tables.export(spark, "glue-jobs", raw, table="other_jobs").count() == 1
    with pytest.raises(ValueError):
        tables.export(spark, "nothing", raw)
    for name in ("glue_jobs", "other_jobs"):
        spark.sql(f"drop table {name}")


def test_work_dir_follows_the_session(spark):
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_chosen_broadcast_threshold_is_kept(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.unset(key)
    assert tune(spark).conf.get(key) == "10485760b"
    spark.conf.set(key, "-1")
    assert tune(spark).conf.get(key) == "-1"
    spark.conf.unset(key)


# Person records


def test_persons_are_the_same_on_any_partitioning(spark):
    one, many = (sorted(records.persons(spark, 200, seed=3, partitions=p).collect()) for p in (1, 7))
    assert one == many
    assert len({r["id"] for r in one}) == 200
    assert sorted(records.persons(spark, 200, seed=4).collect()) != one
    assert all(records.MIN_AGE <= r["age"] <= records.MAX_AGE and "@" in r["email"] for r in one)
    assert all(len(r["address"]["zipcode"]) == 7 for r in one)
    assert records.persons(spark, 1).schema.simpleString() == spark.createDataFrame([], records.PERSON).schema.simpleString()


def test_bulk_file(spark, tmp_path):
    records.write_persons(spark, str(tmp_path / "p"))
    assert spark.read.schema(records.PERSON).json(str(tmp_path / "p")).distinct().count() == 600


def test_records_round_trip(spark):
    people = records.persons(spark, 20)
    encoded = records.to_records(people)
    assert encoded.columns == ["partition_key", "data"]
    assert encoded.select("partition_key").distinct().count() == 20
    assert sorted(records.from_records(encoded).collect()) == sorted(people.collect())


def test_stream_takes_each_file_once(spark, tmp_path):
    landing, checkpoint, out = (str(tmp_path / n) for n in ("landing", "checkpoint", "out"))

    def ingest():
        stream = records.read_persons(spark, landing, max_files_per_trigger=1)
        records.ingest(stream, checkpoint, path=out).awaitTermination()
        return spark.read.parquet(out)

    files.write_jsonl(records.persons(spark, 30, seed=1), landing)
    assert ingest().count() == 30
    assert ingest().count() == 30
    files.write_jsonl(records.persons(spark, 12, seed=2), landing, mode="append")
    (tmp_path / "landing" / "bad.json").write_text("broken\n")
    found = ingest()
    assert found.count() == 43
    assert [r["malformed"] for r in found.filter(F.col("id").isNull()).collect()] == ["broken"]
    flat = records.flatten(records.persons(spark, 30, seed=1).unionAll(records.persons(spark, 12, seed=2)))
    assert sorted(found.filter("id is not null").select(*flat.columns).collect()) == sorted(flat.collect())


def test_stream_into_a_table(spark, tmp_path):
    landing = str(tmp_path / "landing")
    records.write_persons(spark, landing, 5)
    stream = records.read_persons(spark, landing)
    records.ingest(stream, str(tmp_path / "checkpoint"), table="people").awaitTermination()
    assert spark.table("people").count() == 5
    spark.sql("drop table people")
    with pytest.raises(ValueError):
        records.ingest(stream, "x")
