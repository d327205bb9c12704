"""Tables: publishing in two steps, interleaved order, bloom filters."""

import os
import re
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from metascope.operators import filters, lookups
from metascope.sinks import layout, tables


def folders(path):
    return sorted(p.name for p in Path(path).iterdir() if p.name.startswith("v-"))


def test_a_failing_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save_table(spark.range(10), "published", path=path)
    failing = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(PySparkException):
        tables.save_table(failing, "published", path=path)
    assert spark.table("published").count() == 10
    assert len(folders(path)) == 1
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("published")] == ["published"]
    spark.sql("drop table published")


def test_a_failing_publication_restores_the_name(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.save_table(spark.range(10), "published", path=path)
    sql = type(spark).sql

    def refuse(self, text, *args, **options):
        if re.match(r"alter table published_v_\w+ rename to published$", text) and not text.split()[2].endswith("_old"):
            raise RuntimeError("no catalog")
        return sql(self, text, *args, **options)

    monkeypatch.setattr(type(spark), "sql", refuse)
    with pytest.raises(RuntimeError):
        tables.save_table(spark.range(3), "published", path=path)
    monkeypatch.undo()
    assert spark.table("published").count() == 10
    spark.sql("drop table published")


def test_versions_are_kept_and_removed(spark, tmp_path):
    path = str(tmp_path / "t")
    reading = tables.save_table(spark.range(5), "published", path=path)
    for n in (6, 7, 8):
        assert tables.save_table(spark.range(n).withColumn(f"c{n}", F.lit(n)), "published", path=path, keep=2).count() == n
    assert len(folders(path)) == 3
    assert tables.save_table(spark.range(9), "published", path=path).columns == ["id"]
    assert len(folders(path)) == 2 and reading.columns == ["id"]
    spark.sql("drop table published")


def test_a_reader_of_the_old_version_goes_on(spark, tmp_path):
    old = tables.save_table(spark.range(5), "published", path=str(tmp_path / "t"))
    tables.save_table(old.union(spark.range(100, 102)), "published", path=str(tmp_path / "t"))
    assert old.count() == 5 and spark.table("published").count() == 7
    spark.sql("drop table published")


def test_a_table_of_another_kind_is_replaced(spark, tmp_path):
    spark.range(3).write.saveAsTable("published")
    assert tables.save_table(spark.range(4), "published", path=str(tmp_path / "t"), partition_by=[]).count() == 4
    spark.sql("drop table published")


def inventory(spark, n=40_000):
    mixed = F.xxhash64("id")
    return spark.range(0, n, 1, 8).select(
        F.concat(F.pmod(mixed, F.lit(97)).cast("string"), F.lit("/"), "id").alias("key"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000_000)).alias("size"),
        F.timestamp_seconds(1_600_000_000 + F.pmod(F.xxhash64("id", F.lit(2)), F.lit(10_000_000))).alias("last_modified"),
    )


def overlapping(table, size, seconds):
    """(files whose statistics overlap the bounds, all files)."""
    stats = table.groupBy(F.col("_metadata.file_path")).agg(
        F.min("size").alias("a"), F.max("size").alias("b"), F.min("last_modified").cast("long").alias("c"), F.max("last_modified").cast("long").alias("d")
    )
    rows = stats.collect()
    return sum(r["a"] <= size[1] and r["b"] >= size[0] and r["c"] <= seconds[1] and r["d"] >= seconds[0] for r in rows), len(rows)


def test_interleaved_table_prunes_by_size_and_time(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    df = inventory(spark)
    sorted_ = tables.save_table(df, "by_key", path=str(tmp_path / "a"), cluster_by=["key"])
    mixed = tables.save_table(df, "by_three", path=str(tmp_path / "b"), interleave_by=["key", "size", "last_modified"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert mixed.exceptAll(df).count() == 0 and mixed.count() == 40_000
    bounds = (100_000, 200_000), (1_601_000_000, 1_602_000_000)
    hit, files = overlapping(sorted_, *bounds)
    assert hit == files
    hit, files = overlapping(mixed, *bounds)
    assert files >= 32 and hit <= files / 6
    # A time bound alone prunes, too.
    hit, files = overlapping(mixed, (0, 10**9), (1_601_000_000, 1_602_000_000))
    assert hit <= files / 2
    for name in ("by_key", "by_three"):
        spark.sql(f"drop table {name}")


def test_interleaving_odd_columns(spark):
    rows = [(None, None, 1.5), ("a", 1, None), ("a", 1, None), ("é", -5, float("nan")), ("", 2**62, 0.0)]
    df = spark.createDataFrame(rows, "key string, size long, x double")
    assert sorted(map(str, layout.interleaved(df, ["key", "size"]).collect())) == sorted(map(str, df.collect()))
    assert layout.interleaved(df.limit(0), ["key", "size"]).count() == 0
    assert layout.interleaved(df, ["key", "key"]).count() == 5
    with pytest.raises(ValueError):
        layout.interleaved(df, ["key"] * 1, bits=64)
    with pytest.raises(ValueError):
        tables.save_table(df, "x", cluster_by=["key"], interleave_by=["size"])


def scanned(df):
    """Rows that the scans of a plan gave."""
    df.collect()

    def walk(node):
        found = [node]
        for children in (node.children(), node.innerChildren() if "AdaptiveSparkPlan" in node.nodeName() else None):
            if children is not None:
                for i in range(children.size()):
                    found += walk(children.apply(i))
        return found

    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    return sum(n.metrics().apply("numOutputRows").value() for n in walk(plan) if n.nodeName().startswith("Scan"))


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    """A lookup of a few ids reads the row groups that may hold them, of an id column in no order."""
    df = spark.range(0, 200_000, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).alias("query_id"), "id")
    wanted = [r[0] for r in df.filter("id in (5, 77777)").select("query_id").collect()] + ["not there"]
    reads = {}
    for name, find_by in (("plain", []), ("found", ["query_id"])):
        spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", str(256 * 1024))
        saved = tables.save_table(df, name, path=str(tmp_path / name), find_by=find_by)
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
        hit = lookups.by_ids(saved, "query_id", wanted)
        assert sorted(r["id"] for r in hit.collect()) == [5, 77777]
        reads[name] = scanned(lookups.by_ids(saved, "query_id", wanted))
        spark.sql(f"drop table {name}")
    assert reads["plain"] == 200_000 and reads["found"] <= 40_000


def test_short_id_lists(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"))
    assert lookups.by_ids(df, "k", []).count() == 0
    assert lookups.by_ids(df, "k", [str(i) for i in range(0, 100, 3)] + ["0", "x"]).count() == 34
    assert os.sep in str(Path.cwd()) and filters.prefix(df, "k", "9").count() == 11
