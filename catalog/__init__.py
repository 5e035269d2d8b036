"""Queries over the test tables, each with its SQL counterpart where SQL can say it."""

from catalog import grids, recovery, scalars, stages, storage, upkeep  # noqa: F401  (they register themselves)
from catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
