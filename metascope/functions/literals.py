"""Options given as text by the caller, parsed once on the driver.

A malformed option raises ``ValueError``; the same text in a *column* becomes
NULL instead (see ``columns``).
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable
from datetime import UTC, datetime, timedelta

# Size suffixes and their factors in bytes.
SIZE_UNITS = {"B": 1, "KB": 1024, "MB": 1024**2, "GB": 1024**3, "TB": 1024**4}

# Units of a relative time and their length in seconds.
TIME_UNITS = {"minute": 60, "hour": 3600, "day": 86400, "week": 604800}

SIZE_PATTERN = r"^([+-]?(?:\d+\.?\d*|\.\d+)(?:E[+-]?\d+)?)\s*(TB|GB|MB|KB|B)?$"
AGO_PATTERN = r"^([+-]?\d+)\s+(minute|hour|day|week)s*\s+ago$"

# Dates, and times with at least minutes, with or without an offset; options and columns alike.
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"

Instant = datetime | str


def instant(value: Instant) -> datetime:
    """A point in time in UTC; text is ISO-8601, and no offset means UTC."""
    if isinstance(value, str) and not re.match(ISO_PATTERN, value.strip()):
        raise ValueError(f"not a time: {value!r}")
    moment = datetime.fromisoformat(value.strip()) if isinstance(value, str) else value
    return moment.replace(tzinfo=UTC) if moment.tzinfo is None else moment.astimezone(UTC)


def days_before(as_of: Instant, days: int) -> datetime:
    return instant(as_of) - timedelta(days=days)


def size(value: int | str) -> int:
    """Bytes from ``10KB``-like text, any case; the fraction is cut off."""
    if isinstance(value, int):
        return value
    found = re.match(SIZE_PATTERN, value.strip().upper())
    if not found:
        raise ValueError(f"not a size: {value!r}")
    number, unit = found.groups()
    return int(float(number) * SIZE_UNITS[unit]) if unit else int(number)


def time_bound(value: Instant, as_of: Instant | None = None) -> datetime:
    """A bound given as a time, as ISO text, or as ``N units ago`` before ``as_of``."""
    if isinstance(value, str):
        found = re.match(AGO_PATTERN, value.strip().lower())
        if found:
            if as_of is None:
                raise ValueError(f"{value!r} needs as_of")
            return instant(as_of) - timedelta(seconds=int(found[1]) * TIME_UNITS[found[2]])
    return instant(value)


def comma_list(value: str | Iterable[str] | None) -> list[str]:
    """Trimmed items of a comma list; blanks between commas are kept."""
    if not value:
        return []
    return [item.strip() for item in value.split(",")] if isinstance(value, str) else list(value)


def tag_pairs(value: str | Iterable[str] | dict[str, str] | None, trim: bool = True) -> dict[str, str]:
    """``k1=v1,k2=v2`` (or a list of ``k=v``) as a dict.

    Split at the first ``=``; pieces without one are ignored; the last value of
    a repeated key wins.
    """
    if isinstance(value, dict):
        return dict(value)
    pieces = value.split(",") if isinstance(value, str) else list(value or ())
    split = (piece.split("=", 1) for piece in pieces if "=" in piece)
    return {k.strip(): v.strip() for k, v in split} if trim else dict(split)


def java_regex(pattern: str) -> str:
    """Named groups of a Python pattern, spelled the way Spark's regex wants them."""
    return re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", pattern.replace("(?P<", "(?<"))


def _runs(items, runs: list[list[str]], top: bool) -> None:
    """Adds the texts that every match of a parsed pattern holds to ``runs``; a new run begins where they need not adjoin."""
    parser = re._parser
    for number, (kind, what) in enumerate(items):
        if kind == parser.LITERAL:
            runs[-1].append(chr(what))
        elif kind == parser.AT:
            # Only a text's begin, as the first thing of all, ties what follows to the front.
            if top and number == 0 and what in (parser.AT_BEGINNING, parser.AT_BEGINNING_STRING):
                runs[0].append("^")
        elif kind == parser.SUBPATTERN and not what[1] and not what[2]:
            _runs(what[3], runs, False)
        else:
            runs.append([])
            if kind in (parser.MAX_REPEAT, parser.MIN_REPEAT) and what[0] >= 1:
                _runs(what[2], runs, False)
                runs.append([])


def required_literals(pattern: str) -> tuple[str, str]:
    """(prefix, part): what a text must start with, and the longest text it must contain, for ``pattern`` to be found in it.

    Either is empty if the pattern doesn't tell: alternatives, classes and optional
    parts do not, nor does anything under a flag.  Only what surely holds is told, so
    a filter on it loses no row.
    """
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        try:
            parsed = re._parser.parse(pattern)
        except (re.error, OverflowError):
            return "", ""
    if parsed.state.flags & ~re.UNICODE.value:
        return "", ""
    runs: list[list[str]] = [[]]
    _runs(parsed, runs, True)
    anchored = parsed.data[:1] and parsed.data[0][0] == re._parser.AT and runs[0][:1] == ["^"]
    if anchored:
        runs[0] = runs[0][1:]
    texts = ["".join(run) for run in runs]
    return texts[0] if anchored else "", max(texts, key=len)
