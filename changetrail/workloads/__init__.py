"""Registered queries over the test tables, each with its SQL counterpart."""

from .queries import QUERIES
from .oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]
