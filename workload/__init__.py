"""Queries over the given tables, each with the SQL that must give the same rows."""

from workload.registry import ORACLE, QUERIES
from workload import changes, checks, flows, graphs, logs, params, records, sources, streams  # noqa: F401

__all__ = ["ORACLE", "QUERIES"]
