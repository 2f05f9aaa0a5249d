"""Registered queries, each beside the SQL that must give the same rows."""

from . import (  # noqa: F401
    catalog, customers, functions, landing, lines, operations, quality, raw_zone, sales, upkeep, versions,
)
from .core import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
