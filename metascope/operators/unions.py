"""Unions of listings with different columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ML_TYPES = ("training", "processing", "transform")


def union(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, columns matched by name, NULL where a part has none."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def ml_jobs(training: DataFrame, processing: DataFrame, transform: DataFrame, job_type: str = "all") -> DataFrame:
    """Model jobs of one type, or of all."""
    parts = dict(zip(ML_TYPES, (training, processing, transform), strict=True))
    if job_type == "all":
        return union(*parts.values())
    if job_type not in parts:
        raise ValueError(f"type must be one of {ML_TYPES} or 'all': {job_type!r}")
    return parts[job_type]


def services(**named: DataFrame) -> DataFrame:
    """(service, name) of all resources, e.g. ``services(jobs=jobs, streams=streams)``."""
    return union(*[df.select(F.lit(service).alias("service"), F.col("name")) for service, df in named.items()])
