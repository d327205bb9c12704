"""What the operators of this subpackage share: hash folds, table reading, and tables in the shared folder."""

from __future__ import annotations

import sys
from types import ModuleType

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir

# Tasks get this subpackage's functions by value, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

# Fixed by the definition of words and lines: the ASCII white space.
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's text modulo n; NULL for a NULL id, which is then in no fold."""
    return F.crc32(doc_id.cast("string")) % n


# What is written in full needs its shuffles no longer; with this setting Spark removes them when the write has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, purpose: str, partition_by: str | None = None) -> DataFrame:
    """The rows written to a new table in the cluster's shared folder, and read from there: it cuts the lineage."""
    path = work_dir(df.sparkSession, purpose)
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP)
    conf.set(CLEAN_UP, "true")
    try:
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        writer.parquet(path)
    finally:
        conf.set(CLEAN_UP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of so many rows at most, so that long texts don't add up in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def row_hash(*columns: str, seed: int = 0) -> Column:
    """64 bits of the named columns; NULLs count as such."""
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in columns])


def one_per_id(rows: DataFrame, id_column: str, label: str, text: str) -> DataFrame:
    """(label, text) of one row of each id: that with the least hash of its text."""
    first = F.min_by(text, F.struct(F.xxhash64(text), F.col(text)))
    return rows.groupBy(id_column).agg(F.min(label).alias(label), first.alias(text)).select(label, text)


def others(df: DataFrame, *added: str) -> list[str]:
    """The columns of ``df`` without those that the added ones take the place of; names are the same in any case."""
    taken = {name.lower() for name in added}
    return [c for c in df.columns if c.lower() not in taken]


def packed(names: list[str]) -> Column:
    """The named columns as one struct; a name may hold dots."""
    return F.struct(*[F.col(f"`{c}`") for c in names])


def process_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, across its tasks."""
    home = sys.modules.setdefault("_worker_caches", ModuleType("_worker_caches"))
    return home.__dict__.setdefault(name, {})


def drop_caches() -> None:
    """Frees what tasks of other operators have left in this Python worker; they learn it anew if they come back."""
    sys.modules.pop("_worker_caches", None)
