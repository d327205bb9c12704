"""Reports over several listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import filters, ordering, unions


def cost_report(
    objects: DataFrame,
    training: DataFrame,
    streams: DataFrame,
    *,
    min_size: int | str = "10GB",
    top: int | None = None,
    over_seconds: int = 7200,
    over_shards: int = 10,
) -> DataFrame:
    """(section, name, instance_type, metric): large objects in GiB, long trainings in hours, streams by shards.

    ``instance_type`` is that of trainings listed with their details, NULL elsewhere.

    ``top`` keeps the so many largest objects; all of them without it.
    """
    large = filters.in_range(objects, "size", low=min_size).select("key", "size")
    if top is not None:
        large = ordering.limit(large, top, F.desc("size"), "key")
    long = filters.above(training, "training_time_seconds", over_seconds)
    wide = filters.above(streams, "shard_count", over_shards)

    def section(df, label, name, metric):
        instance = F.col("instance_type") if "instance_type" in df.columns else F.lit(None).cast("string")
        return df.select(F.lit(label).alias("section"), F.col(name).alias("name"), instance.alias("instance_type"), metric.alias("metric"))

    return unions.union(
        section(large, "large_objects", "key", C.gib("size")),
        section(long, "long_training", "name", C.hours("training_time_seconds")),
        section(wide, "wide_streams", "name", F.col("shard_count").cast("double")),
    )


def large_tables(tables: DataFrame, over_bytes: int = 1024**3) -> DataFrame:
    """Catalog tables over a size, in GiB."""
    return filters.above(tables, "size_bytes", over_bytes).select("table", C.gib("size_bytes").alias("size_gb"))
