"""Queries over the test tables, each with its SQL twin where SQL can say it."""

from workload import exports, loads, matching, operators, sources, versions  # noqa: F401
from workload.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
