"""Operators for preparing training text, and their registered queries."""

from .queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
