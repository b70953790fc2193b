"""Query registry: each query is registered with its DuckDB oracle SQL
(or none, for operators SQL cannot express)."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
HEADLINE: list[str] = []


def register(name: str, sql: str | None = None, headline: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        if headline:
            HEADLINE.append(name)
        return fn
    return deco
