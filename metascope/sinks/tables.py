"""Named tables, and the export of listings under their default names."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..sources import exports
from . import layout


def check_name(name: str) -> str:
    """The name, if it is a plain identifier; else ``ValueError``."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
        raise ValueError(f"invalid table name: {name!r}")
    return name


def _folder(spark: SparkSession, path: str) -> tuple[object, object]:
    """A path and its file system, as Spark's own file access has them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, base: str) -> list[str]:
    """The version folders below ``base``, oldest first."""
    folder, files = _folder(spark, base)
    if not files.exists(folder):
        return []
    names = sorted(status.getPath().getName() for status in files.listStatus(folder))
    return [f"{base}/{name}" for name in names if name.startswith("v-")]


def _publish(spark: SparkSession, staged: str, name: str) -> None:
    """Gives the written table ``staged`` the name; until then, and if it fails, the old table has it."""
    if not spark.catalog.tableExists(name):
        spark.sql(f"alter table {staged} rename to {name}")
        return
    old = f"{staged}_old"
    spark.sql(f"alter table {name} rename to {old}")
    try:
        spark.sql(f"alter table {staged} rename to {name}")
    except BaseException:
        spark.sql(f"alter table {old} rename to {name}")
        raise
    spark.sql(f"drop table {old}")


def save_table(
    df: DataFrame,
    name: str,
    *,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    interleave_by: Sequence[str] = (),
    bucket_by: tuple[int, str] | None = None,
    find_by: Sequence[str] = (),
    keep: int = 1,
) -> DataFrame:
    """Creates or replaces a table and returns it.

    In two steps: the rows are written to a fresh folder ``v-...`` below ``path``, or
    below the table's folder in the warehouse; then the name is given to what was
    written.  A write that fails leaves the old table as it was.  ``keep`` earlier
    folders stay for readers that have begun; older ones are removed.

    ``partition_by`` suits columns that are filtered on and have few values (a
    bucket, a snapshot date); rows are dealt by them first, so that a value has
    few files, and a hot one several.  ``cluster_by`` sorts the rows into ranges of
    equal size, so that filters on prefixes and bounds of the first column skip most
    files; give it unique columns, e.g. bucket and key, and a hot bucket fills many
    files.  ``interleave_by`` clusters by several columns at once, for filters on any
    of them (see ``layout.interleaved``).  ``bucket_by`` (number, column) stores rows
    by a *unique* join key, such as an execution's ARN, and joins on it need no
    shuffle; a hot key would end up in one file and one task.  ``find_by`` names id
    columns that get bloom filters, so that looking up a few ids skips row groups.
    """
    spark = df.sparkSession
    check_name(name)
    if cluster_by and interleave_by:
        raise ValueError("give cluster_by or interleave_by")
    base = (path or f"{spark.catalog.getDatabase(spark.catalog.currentDatabase()).locationUri}/{name}.versions").rstrip("/")
    version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    staged = f"{name}_{version.replace('-', '_')}"

    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    elif interleave_by:
        df = layout.interleaved(df, interleave_by)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("error").format("parquet").option("path", f"{base}/{version}")
    for column in find_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    try:
        writer.saveAsTable(staged)
        _publish(spark, staged, name)
    except BaseException:
        spark.sql(f"drop table if exists {staged}")
        folder, files = _folder(spark, f"{base}/{version}")
        files.delete(folder, True)
        raise
    for old in _versions(spark, base)[: -1 - keep]:
        folder, files = _folder(spark, old)
        files.delete(folder, True)
    return spark.table(name)


# The names of the listings and of their tables.
EXPORTS: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    "s3": ("s3_objects", exports.objects),
    "athena": ("athena_tables", exports.catalog_metadata),
    "glue-jobs": ("glue_jobs", exports.jobs),
    "glue-job-runs": ("glue_job_runs", exports.job_runs),
    "athena-errors": ("athena_query_errors", exports.query_errors),
    "sm-pipeline-executions": ("sm_pipeline_executions", exports.pipeline_executions),
    "sm-training-jobs": ("sm_training_jobs", exports.training_jobs),
    "sm-processing-jobs": ("sm_processing_jobs", exports.processing_jobs),
    "cloudformation": ("cloudformation_stacks", exports.stacks),
}


def export(
    spark: SparkSession, listing: str, *records: DataFrame, table: str | None = None, path: str | None = None, **options
) -> DataFrame:
    """Runs a listing over its landed ``records`` and saves it under its default name or ``table``."""
    if listing not in EXPORTS:
        raise ValueError(f"listing must be one of {sorted(EXPORTS)}: {listing!r}")
    default_name, build = EXPORTS[listing]
    return save_table(build(*records, **options), table or default_name, path=path)
