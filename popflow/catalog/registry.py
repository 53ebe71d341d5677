"""Registry of queries: a callable on the role tables and, where expressible, its SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from popflow.catalog.roles import Roles, with_roles

_MODULES = ["rebasing", "identifiers", "seeding", "controls", "loading", "fitting",
            "synthesizing", "geometry"]
_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(roles) -> DataFrame`` under ``name``; ``sql`` may use the role tables."""
    def register(fn: Callable[[Roles], DataFrame]):
        if name in _queries:
            raise ValueError(f"query {name} is registered twice")
        _queries[name] = lambda spark, sf_dir: fn(Roles(spark, sf_dir))
        if sql is not None:
            _sql[name] = with_roles(sql)
        return fn
    return register


def _load() -> None:
    for module in _MODULES:
        importlib.import_module(f"popflow.catalog.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
