"""Queries over the given tables, one per operator, with the SQL they are checked against."""

from tallyloom.catalog import matching, readers, runs, scalars, tables  # noqa: F401
from tallyloom.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
