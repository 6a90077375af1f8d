"""Registry of named queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from opinara.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Tables], DataFrame]
    sql: str | None


_QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register `fn(tables) -> DataFrame` under `name` with its oracle SQL."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = Query(name, fn, sql)
        return fn

    return add


def _bind(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return q.run(Tables(spark, sf_dir))

    run.__name__ = q.name
    return run


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(q) for name, q in _QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: q.sql for name, q in _QUERIES.items() if q.sql is not None}
