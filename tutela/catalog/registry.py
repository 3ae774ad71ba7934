"""Registry of bound queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tutela.catalog.bindings import Bound
from tutela.catalog.views import sql as with_views


@dataclass(frozen=True)
class Query:
    build: Callable[[Bound], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(bound) -> DataFrame`` under a name, with the SQL text an
    independent engine runs on the same tables."""
    def keep(build):
        if name in REGISTRY:
            raise KeyError(f"{name} registered twice")
        REGISTRY[name] = Query(build, sql)
        return build
    return keep


def add(name: str, build: Callable[[Bound], DataFrame], sql: str | None = None) -> None:
    query(name, sql)(build)


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(q: Query):
        return lambda spark, folder: q.build(Bound(spark, folder))
    return {n: bind(q) for n, q in REGISTRY.items()}


def oracles() -> dict[str, str]:
    return {n: with_views(q.sql) for n, q in REGISTRY.items() if q.sql}
