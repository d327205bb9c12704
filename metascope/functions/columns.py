"""Scalar functions over columns, all from Spark built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .literals import AGO_PATTERN, ISO_PATTERN, SIZE_PATTERN, SIZE_UNITS, TIME_UNITS, Instant, instant

_BLANKS = " \t\n\r\x0b\x0c"
# A string, kept, or blanks, dropped.
_OUTSIDE_BLANKS = r'("(?:[^"\\]++|\\.)*+")|\s+'


def col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def at(moment: Instant | Column) -> Column:
    """A timestamp column for a driver-side instant (columns pass through)."""
    return moment if isinstance(moment, Column) else F.lit(instant(moment))


def _strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANKS))


def _factor(units: dict[str, int], unit: Column) -> Column:
    """The number listed for a unit; one lookup in a constant map."""
    pairs = [F.lit(x) for name, n in units.items() for x in (name, n)]
    return F.try_element_at(F.create_map(*pairs).cast("map<string,bigint>"), unit)


def size_bytes(text: str | Column) -> Column:
    """``10KB``-like text to bytes; malformed text and overflow become NULL."""
    clean = F.upper(_strip(col(text)))
    unit = F.regexp_extract(clean, SIZE_PATTERN, 2)
    # A unit is found only in a well-formed size, so what precedes it is a number.
    number = F.substr(clean, F.lit(1), F.length(clean) - F.length(unit))
    scaled = (number.try_cast("double") * _factor(SIZE_UNITS, unit)).try_cast("bigint")
    # NULL without a unit.  As the first operand it is always evaluated, so the
    # regex, which occurs twice in it, runs once.
    return F.coalesce(scaled, clean.try_cast("bigint"))


def time_bound(text: str | Column, as_of: Instant | Column) -> Column:
    """ISO text, or ``N units ago`` before ``as_of``, to a timestamp; else NULL."""
    clean = F.lower(_strip(col(text)))
    amount = F.regexp_extract(clean, AGO_PATTERN, 1).try_cast("bigint")
    micros = _factor({name: s * 1_000_000 for name, s in TIME_UNITS.items()}, F.regexp_extract(clean, AGO_PATTERN, 2))
    relative = F.timestamp_micros(F.try_subtract(F.unix_micros(at(as_of)), F.try_multiply(amount, micros)))
    return F.coalesce(relative, iso_parse(text))


def iso_parse(text: str | Column) -> Column:
    """ISO-8601 text to a timestamp (``Z`` and offsets honoured); else NULL."""
    clean = _strip(col(text))
    return F.when(clean.rlike(ISO_PATTERN), F.try_to_timestamp(clean))


def iso_text(ts: str | Column) -> Column:
    """A timestamp as ISO-8601 text; microseconds only where there are some."""
    ts = col(ts)
    whole = F.unix_micros(ts) % 1_000_000 == 0
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    )


def tag_map(text: str | Column, trim: bool = True) -> Column:
    """``k1=v1,k2=v2`` to a map; junk is dropped and the last of equal keys wins."""
    clean = _strip if trim else (lambda c: c)
    pieces = F.filter(F.split(F.coalesce(col(text), F.lit("")), ","), lambda p: F.contains(p, F.lit("=")))
    entries = F.transform(
        pieces,
        lambda p: F.struct(
            clean(F.substring_index(p, "=", 1)).alias("key"),
            clean(F.substr(p, F.locate("=", p) + F.lit(1))).alias("value"),
        ),
    )
    return map_of_entries(entries)


def map_of_entries(entries: Column) -> Column:
    """Array of (key, value) structs to a map where the last of equal keys wins."""
    last_only = F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(entries, i + F.lit(2), F.size(entries)), lambda later: later["key"] == e["key"]),
    )
    return F.map_from_entries(last_only)


def last_segment(name: str | Column) -> Column:
    """Text after the last dot; a missing name is the empty string."""
    return F.coalesce(F.substring_index(col(name), ".", -1), F.lit(""))


def first_token(name: str | Column, sep: str = "-") -> Column:
    """Text before the first separator."""
    return F.substring_index(col(name), sep, 1)


def unquote(text: str | Column) -> Column:
    """Text without the double quotes at its ends; missing is the empty string."""
    return F.coalesce(F.btrim(col(text), F.lit('"')), F.lit(""))


def whole_seconds(start: str | Column, end: str | Column) -> Column:
    """Seconds from start to end, cut toward zero; NULL while there is no end."""
    micros = F.unix_micros(col(end)) - F.unix_micros(col(start))
    return F.call_function("div", micros, F.lit(1_000_000).cast("bigint"))


def table_size(properties: str | Column) -> Column:
    """Bytes from ``totalSize``, or from ``rawDataSize`` where that key is absent.

    Presence of the key decides, so a bad ``totalSize`` is NULL, not a fallback.
    """
    properties = col(properties)
    text = F.when(
        F.map_contains_key(properties, F.lit("totalSize")), F.try_element_at(properties, F.lit("totalSize"))
    ).otherwise(F.try_element_at(properties, F.lit("rawDataSize")))
    return _strip(text).try_cast("bigint")


def named_types(columns: str | Column) -> Column:
    """Catalog columns to (name, type) structs, a missing type being empty."""
    return F.transform(
        F.coalesce(col(columns), F.array().cast("array<struct<Name:string,Type:string>>")),
        lambda c: F.struct(c["Name"].alias("name"), F.coalesce(c["Type"], F.lit("")).alias("type")),
    )


def names_of(columns: str | Column) -> Column:
    """Names of catalog columns, in order."""
    return F.transform(
        F.coalesce(col(columns), F.array().cast("array<struct<Name:string,Type:string>>")), lambda c: c["Name"]
    )


def cardinality(array: str | Column) -> Column:
    """Number of elements; a missing array has none."""
    array = col(array)
    return F.when(array.isNull(), F.lit(0)).otherwise(F.size(array))


def first_element(array: str | Column) -> Column:
    """First element, or NULL for an empty or missing array."""
    return F.get(col(array), F.lit(0))


def _json_value(text: Column) -> tuple[Column, Column]:
    """The first JSON value in the text, and whether the text is that value and no more.

    The parser ignores what follows a complete value.  Wrapped once as the only
    element of an array and once as the only field of an object, text after the
    value breaks one of the two.
    """
    elements = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    field = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    value = F.try_variant_get(elements, "$[0]", "variant")
    more = F.try_variant_get(elements, "$[1]", "variant")
    return value, value.isNotNull() & more.isNull() & field.isNotNull()


def is_json(text: str | Column) -> Column:
    """Whether the text is one JSON value; missing text counts as ``{}``."""
    _, valid = _json_value(F.coalesce(col(text), F.lit("{}")))
    return valid


def json_text(text: str | Column) -> Column:
    """Compact JSON for valid input, the raw text for invalid, ``{}`` for missing.

    Only blanks outside strings go: numbers keep their spelling and keys their order.
    """
    raw = F.coalesce(col(text), F.lit("{}"))
    _, valid = _json_value(raw)
    return F.when(valid, F.regexp_replace(raw, _OUTSIDE_BLANKS, "$1")).otherwise(raw)


def gib(size: str | Column) -> Column:
    return col(size) / F.lit(1024**3)


def hours(seconds: str | Column) -> Column:
    return col(seconds) / F.lit(3600)
