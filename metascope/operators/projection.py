"""Column selection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import literals as L
from ..functions.columns import col


def project(df: DataFrame, fields: str | Iterable[str] | None = None) -> DataFrame:
    """The named fields, in the order given; an unknown field is an empty text."""
    wanted = L.comma_list(fields)
    if not wanted:
        return df
    return df.select(*[F.col(f"`{f}`") if f in df.columns else F.lit("").alias(f) for f in wanted])


def default(column: str | Column, value) -> Column:
    """The column, with ``value`` where it is missing."""
    return F.coalesce(col(column), F.lit(value))


def labelled(df: DataFrame, **labels: str) -> DataFrame:
    """``df`` with constant text columns, e.g. ``service="jobs"``."""
    return df.withColumns({name: F.lit(value) for name, value in labels.items()})
