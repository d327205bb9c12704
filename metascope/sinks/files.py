"""JSON lines, TSV and CSV folders.  Each writes in parallel, one file per partition."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import iso_text
from ..operators.projection import project


# Times inside nested values keep their microseconds.
NESTED = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _text(field: T.StructField) -> Column:
    """A column as text: ISO-8601 times, JSON for nested values, empty for NULL."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.TimestampType):
        value = iso_text(value)
    elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        value = F.to_json(value, NESTED)
    return F.coalesce(value.cast("string"), F.lit("")).alias(field.name)


def write_jsonl(
    df: DataFrame,
    path: str,
    fields: str | Iterable[str] | None = None,
    keep_nulls: bool = False,
    mode: str = "errorifexists",
) -> None:
    """One JSON object per line; NULL fields are left out unless ``keep_nulls``."""
    df = project(df, fields)
    times = {f.name: iso_text(f.name) for f in df.schema if isinstance(f.dataType, T.TimestampType)}
    out = df.withColumns(times) if times else df
    out.write.mode(mode).options(ignoreNullFields=str(not keep_nulls).lower(), **NESTED).json(path)


def write_tsv(
    df: DataFrame,
    path: str,
    fields: str | Iterable[str] | None = None,
    header: bool = True,
    mode: str = "errorifexists",
) -> None:
    """Tab-separated values, not quoted.

    The header is the first file alone: the files put together in name order
    are one table with one header.
    """
    df = project(df, fields)
    lines = df.select(F.concat_ws("\t", *[_text(f) for f in df.schema]).alias("value"))
    if header:
        names = df.sparkSession.createDataFrame([("\t".join(df.columns),)], "value string").coalesce(1)
        lines = names.unionAll(lines)
    lines.write.mode(mode).text(path)


def write_csv(
    df: DataFrame,
    path: str,
    fields: str | Iterable[str] | None = None,
    header: bool = True,
    mode: str = "errorifexists",
) -> None:
    """Comma-separated values, quoted where needed, with a header in each file."""
    df = project(df, fields)
    out = df.select(*[_text(f) for f in df.schema])
    out.write.mode(mode).options(
        header=str(header).lower(),
        escape='"',
        emptyValue="",
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
    ).csv(path)
