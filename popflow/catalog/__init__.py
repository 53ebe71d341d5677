"""Registered queries and the SQL each must agree with."""

from popflow.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
