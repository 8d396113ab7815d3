"""Name -> query and name -> SQL, gathered from the query modules."""

from __future__ import annotations

from . import code_queries, deps_queries, relational_queries, report_queries, rollup_queries, scalar_queries, stream_queries, usage_queries  # noqa: F401
from .base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
