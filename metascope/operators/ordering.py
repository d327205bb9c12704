"""Sorting, limits, top-k and paging, with an order that leaves no ties open."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_dir


def newest_first(jobs: DataFrame) -> list[Column]:
    """Sort key of unioned model jobs: newest, then type in listing order, then name."""
    kind = F.col("type")
    rank = F.when(kind == "training", 0).when(kind == "processing", 1).otherwise(2)
    return [F.desc("created_time"), rank, F.col("name")]


def sort_newest_first(jobs: DataFrame) -> DataFrame:
    return jobs.orderBy(*newest_first(jobs))


def limit(df: DataFrame, n: int | None, *order: str | Column) -> DataFrame:
    """The first ``n`` rows in ``order``; all if ``n`` is None, none if it is negative.

    Without an order the rows would be arbitrary ones, so one is required.  The
    rows kept pass through one task; ``first_rows`` keeps many in parallel, and
    ``page`` reads on through long listings.
    """
    if not order:
        raise ValueError("limit needs an order")
    ordered = df.orderBy(*order)
    return ordered if n is None else ordered.limit(max(n, 0))


# Parts that a range of values is cut into at each step of a selection.
PARTS = 1024


def _whole(kind: T.DataType, column: Column) -> Column | None:
    """The value as a whole number in the same order, if its type has one."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return column.cast("bigint")
    return None


def _cut(numbers: DataFrame, n: int) -> tuple[int, int] | None:
    """(value, rows before it): where the ``n``-th smallest of the column ``v`` lies; None if there are no more than ``n`` rows."""
    facts = numbers.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("n")).first()
    if facts["n"] <= n:
        return None
    low, high, before = facts["low"], facts["high"], 0
    while low < high:
        width = -(-(high - low + 1) // PARTS)
        part = F.floor((F.col("v").cast("decimal(20,0)") - F.lit(low)) / F.lit(width)).cast("int")
        within = numbers.filter(F.col("v").between(low, high))
        counts = sorted(within.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
        for number, rows in counts:
            if before + rows >= n:
                break
            before += rows
        low, high = low + number * width, min(high, low + (number + 1) * width - 1)
    return low, before


def first_rows(df: DataFrame, n: int, by: str, then: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """The first ``n`` rows by ``by`` and, among equal values, by ``then`` (ascending), however large ``n`` is.

    They are selected, not sorted: a histogram of ``by``, of 1,024 parts a step, is
    refined until the value of the ``n``-th row is known.  Rows before that value are
    kept where they are; only those that have it are put in order, in range
    partitions, of which all but one are kept or left whole.  So no task holds the
    ``n`` rows, which come in no order: sort the result if need be.

    ``by`` is a whole number, a date or a time; a text or a fraction is put in order
    like ``then``.  NULLs come last.  Fewer than ``n`` rows are all kept, a negative ``n``
    keeps none.  Equal rows are counted one by one.
    """
    if n <= 0:
        return df.limit(0)
    number = _whole(df.schema[by].dataType, F.col(by))
    if number is None:
        first = F.desc_nulls_last(by) if descending else F.asc_nulls_last(by)
        return _first_in_order(df, n, [first, *[F.asc_nulls_last(c) for c in then]])
    # The complement has the opposite order, and every number has one.
    value = F.bitwise_not(number) if descending else number
    given = df.filter(F.col(by).isNotNull())
    found = _cut(given.select(value.alias("v")), n)
    if found is None:
        missing = n - given.count()
        absent = df.filter(F.col(by).isNull())
        return given.unionByName(_first_in_order(absent, missing, [F.asc_nulls_last(c) for c in then])) if missing else given
    at, before = found
    tied = df.filter(value == at)
    return df.filter(value < at).unionByName(_first_in_order(tied, n - before, [F.asc_nulls_last(c) for c in then]))


def _first_in_order(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows in ``order``, by range partitions: those before the cut are kept whole."""
    numbered = _in_ranges(df, order, "first-rows")
    parts = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    before, cut = 0, None
    for part, rows in parts:
        if before + rows > n:
            cut = part
            break
        before += rows
    if cut is None:
        return numbered.select(*df.columns)
    rest = numbered.filter(F.col("_part") == cut).orderBy("_line").limit(n - before)
    return numbered.filter(F.col("_part") < cut).unionByName(rest).select(*df.columns)


def _in_ranges(df: DataFrame, order: list[Column], purpose: str) -> DataFrame:
    """``df`` written in range partitions, with the number of its partition and one that rises by one a row within it.

    Written, so that all that is read from it has the same partitions.  A last key
    tells equal rows apart, so that many of them fill several partitions.
    """
    tie = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = tie.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie")
    numbered = ranged.select(*df.columns, F.monotonically_increasing_id().alias("_line"))
    path = work_dir(df.sparkSession, purpose)
    numbered.withColumn("_part", F.shiftright("_line", 33)).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def page_index(df: DataFrame, key: str | Sequence[str], n: int = 1000) -> DataFrame:
    """(page, keys): the first key of every page of ``n`` rows, pages counted from 0.

    One pass over the keys puts them in range partitions; counts by partition and
    their running sum give every row its number.  ``read_page`` then reads any page
    directly.
    """
    if n <= 0:
        raise ValueError("a page has at least one row")
    keys = [key] if isinstance(key, str) else list(key)
    lines = _in_ranges(df.select(*keys), [F.col(k) for k in keys], "page-index")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = lines.groupBy("_part").agg(F.min("_line").alias("_first"), F.count(F.lit(1)).alias("_n"))
    parts = parts.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = lines.join(parts, "_part").withColumn("_row", F.col("_line") - F.col("_first") + F.col("_before"))
    first = numbered.filter(F.col("_row") % n == 0)
    return first.select(F.floor(F.col("_row") / n).alias("page"), *keys)


def read_page(df: DataFrame, index: DataFrame, number: int) -> DataFrame:
    """One page of ``df`` by its index: the rows from its first key up to the next page's; none beyond the last.

    ``df`` must have the keys that the index was made of, each once.  The bounds, two
    rows of the index, reach the scan.
    """
    keys = [c for c in index.columns if c != "page"]
    bounds = {row["page"]: [row[k] for k in keys] for row in index.filter(F.col("page").isin(number, number + 1)).collect()}
    if number not in bounds:
        return df.limit(0)
    found = df.filter((F.col(keys[0]) >= bounds[number][0]) & (_beyond(keys, bounds[number]) | _equal(keys, bounds[number])))
    if number + 1 in bounds:
        last = bounds[number + 1]
        found = found.filter((F.col(keys[0]) <= last[0]) & ~(_beyond(keys, last) | _equal(keys, last)))
    return found.orderBy(*keys)


def _equal(keys: list[str], values: list) -> Column:
    same = F.lit(True)
    for name, value in zip(keys, values, strict=True):
        same &= F.col(name) == value
    return same


def _beyond(keys: list[str], values: list) -> Column:
    """(a, b) > (x, y), that is a > x or (a = x and b > y)."""
    beyond = F.lit(False)
    for name, value in reversed(list(zip(keys, values, strict=True))):
        beyond = (F.col(name) > value) | ((F.col(name) == value) & beyond)
    return beyond


def page(df: DataFrame, key: str | Sequence[str], after=None, n: int = 1000) -> DataFrame:
    """The ``n`` rows that follow key ``after``; ``key`` must be unique.

    Paging by key reads on from where the last page ended: unlike an offset,
    a late page costs no more than the first, and rows added meanwhile shift
    nothing.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if after is not None:
        last = [after] if isinstance(key, str) else list(after)
        # The bound on the first key reaches the scan.
        df = df.filter((F.col(keys[0]) >= last[0]) & _beyond(keys, last))
    return df.orderBy(*keys).limit(max(n, 0))
