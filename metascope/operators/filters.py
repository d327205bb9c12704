"""Row filters.  Each is one predicate on plain columns, so it reaches the scan.

The three lookbacks differ on purpose: in whether a missing time passes, and in
whether the cutoff itself belongs to the window.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import literals as L


def prefix(df: DataFrame, column: str, value: str | None) -> DataFrame:
    """Rows whose text starts with ``value``; no value, no filter."""
    return df.filter(F.col(column).startswith(value)) if value else df


def contains(df: DataFrame, column: str, value: str | None) -> DataFrame:
    """Rows whose text contains ``value``; no value, no filter."""
    return df.filter(F.col(column).contains(value)) if value else df


def matches(df: DataFrame, column: str, pattern: str | None) -> DataFrame:
    """Rows where ``pattern`` is found anywhere in the text.

    A regex cannot be pushed to the scan, but what every match must start with or
    contain can: it is taken from the pattern and filtered on first.
    """
    if not pattern:
        return df
    start, part = L.required_literals(pattern)
    df = prefix(df, column, start)
    if part != start:
        df = contains(df, column, part)
    return df.filter(F.col(column).rlike(L.java_regex(pattern)))


def equals(df: DataFrame, column: str, value: str | None) -> DataFrame:
    """Rows with this value; None is no filter, and an empty text is compared like any other."""
    return df.filter(F.col(column) == value) if value is not None else df


def differs(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows with another value, those with none included."""
    return df.filter(~F.col(column).eqNullSafe(value))


def one_of(df: DataFrame, column: str, values: str | Iterable[str] | None) -> DataFrame:
    """Rows whose value is in a list or comma list; an empty list is no filter."""
    wanted = L.comma_list(values)
    return df.filter(F.col(column).isin(wanted)) if wanted else df


def tagged(df: DataFrame, wanted, column: str = "tags", trim: bool = True) -> DataFrame:
    """Rows whose tag map holds every wanted pair; no valid pair, no filter."""
    for key, value in L.tag_pairs(wanted, trim).items():
        df = df.filter(F.try_element_at(F.col(column), F.lit(key)).eqNullSafe(F.lit(value)))
    return df


def in_range(df: DataFrame, column: str, low: int | str | None = None, high: int | str | None = None) -> DataFrame:
    """Rows from ``low`` to ``high``, both included; bounds may be size text."""
    if low is not None:
        df = df.filter(F.col(column) >= L.size(low))
    if high is not None:
        df = df.filter(F.col(column) <= L.size(high))
    return df


def in_period(
    df: DataFrame,
    column: str,
    newer_than: L.Instant | None = None,
    older_than: L.Instant | None = None,
    as_of: L.Instant | None = None,
) -> DataFrame:
    """Rows between two times, both included; bounds may be ``N units ago``."""
    if newer_than:
        df = df.filter(F.col(column) >= F.lit(L.time_bound(newer_than, as_of)))
    if older_than:
        df = df.filter(F.col(column) <= F.lit(L.time_bound(older_than, as_of)))
    return df


def since_or_missing(df: DataFrame, column: str, days: int, as_of: L.Instant) -> DataFrame:
    """Rows of the last ``days`` days, cutoff included; a missing time passes."""
    return df.filter(F.col(column).isNull() | (F.col(column) >= F.lit(L.days_before(as_of, days))))


def failed_since(
    df: DataFrame, state: str, column: str, days: int, as_of: L.Instant, failed: str = "FAILED"
) -> DataFrame:
    """Failed rows of the last ``days`` days, cutoff included; a missing time is dropped."""
    return df.filter((F.col(state) == failed) & (F.col(column) >= F.lit(L.days_before(as_of, days))))


def after(df: DataFrame, column: str, days: int, as_of: L.Instant) -> DataFrame:
    """Rows strictly after the cutoff ``days`` days ago; a missing time is dropped."""
    return df.filter(F.col(column) > F.lit(L.days_before(as_of, days)))


def parseable(df: DataFrame, text: str, into: str) -> DataFrame:
    """Adds ``into``, the time that ``text`` spells, and drops rows where it spells none."""
    return df.withColumn(into, C.iso_parse(text)).filter(F.col(into).isNotNull())


def above(df: DataFrame, column: str, threshold: float) -> DataFrame:
    return df.filter(F.col(column) > threshold)


def listing(
    df: DataFrame,
    name: str,
    *,
    name_prefix: str | None = None,
    name_contains: str | None = None,
    name_regex: str | None = None,
    status: str | Iterable[str] | None = None,
    status_column: str = "status",
    tags=None,
    tags_column: str = "tags",
    trim_tags: bool = True,
) -> DataFrame:
    """All the name, status and tag filters of a listing together."""
    df = prefix(df, name, name_prefix)
    df = contains(df, name, name_contains)
    df = one_of(df, status_column, status)
    df = matches(df, name, name_regex)
    return tagged(df, tags, tags_column, trim_tags)
