"""Derived input tables and the registered queries."""

from . import check_queries, contest_queries, scalar_queries, table_queries, text_queries
from .catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "check_queries", "contest_queries", "scalar_queries", "table_queries", "text_queries"]
