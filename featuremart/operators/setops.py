"""Set operations (ST-01..ST-03)."""

from __future__ import annotations

from functools import reduce
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession


def union_missing_as_null(frames: Sequence[DataFrame]) -> DataFrame:
    """ST-01: union by name of tables with different columns; missing -> null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_same_shape(frames: Sequence[DataFrame], project: Callable[[DataFrame], DataFrame]
                     | Iterable[Column | str] | None = None) -> DataFrame:
    """ST-02: project every source to one shape (same clean-up), union all by
    name (S-21: never positional)."""
    if project is None:
        shaped = list(frames)
    elif callable(project):
        shaped = [project(f) for f in frames]
    else:
        cols = list(project)
        shaped = [f.select(*cols) for f in frames]
    return reduce(lambda a, b: a.unionByName(b), shaped)


def consolidate(spark: SparkSession, parts: Sequence[DataFrame | None], schema) -> DataFrame:
    """ST-03: union the non-empty results; a typed empty frame if none.
    (``None`` marks a part that produced nothing.)"""
    real = [p for p in parts if p is not None]
    if not real:
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b), real)
