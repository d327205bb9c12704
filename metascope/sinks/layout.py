"""Row order of tables that are filtered by several columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ranges


def edges(df: DataFrame, columns: Sequence[str], bits: int, sample: int) -> dict[str, list]:
    """Values that cut each column into 2**bits parts of about the same number of rows.

    They are taken from ``sample`` rows at most, those with the least hashes: the
    sample sets the layout only, and all rows are written.
    """
    drawn = df.select(*columns).orderBy(F.xxhash64(*columns)).limit(sample).collect()
    found = {}
    for name in columns:
        values = sorted(row[name] for row in drawn if row[name] is not None)
        at = [len(values) * i // 2**bits for i in range(1, 2**bits)] if values else []
        found[name] = sorted({values[i] for i in at})
    return found


def interleaved_place(columns: dict[str, Column], bits: int) -> Column:
    """One number from the places of a row in several columns, their bits taken by turns, the highest first."""
    z = F.lit(0).cast("bigint")
    for bit in range(bits):
        for turn, place in enumerate(columns.values()):
            one = F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("bigint")
            z = z.bitwiseOR(F.shiftleft(one, bit * len(columns) + turn))
    return z


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = 6, sample: int = 10_000) -> DataFrame:
    """``df`` in range partitions in which each of ``columns`` spans a small part of its values.

    A column's place is the number of its edges at or below the value (NULL is
    lowest); the places' bits are interleaved, so rows that lie close in all columns
    lie close in the table, and bounds on any of them skip files.  Equal places are
    ordered by the columns themselves, so a hot place fills several files.
    """
    if not 0 < bits * len(columns) < 64:
        raise ValueError("too many bits or columns")
    names = list(dict.fromkeys(columns))
    found = edges(df, names, bits, sample)
    places = {}
    for name in names:
        kind = T.ArrayType(df.schema[name].dataType)
        values = F.array(*[F.lit(v) for v in found[name]]).cast(kind)
        places[name] = ranges.place(values, ranges.halvings(len(found[name])), F.col(name))
    placed = df.withColumn("_place", interleaved_place(places, bits))
    return placed.repartitionByRange("_place", *names).sortWithinPartitions("_place", *names).drop("_place")
