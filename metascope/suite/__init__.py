"""One query per operator over the test tables, with the SQL each must agree with."""

from .registry import ORACLES, QUERIES
from . import actions, aggregates, columns, filters, lookups, ordering, sinks, sources, streaming  # noqa: F401,I001

__all__ = ["ORACLES", "QUERIES"]
