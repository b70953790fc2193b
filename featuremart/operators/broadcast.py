"""Size-checked broadcast joins.

A side is broadcast only after a count proves it holds at most ``max_rows``
rows. The count is a grouped count: every task counts its own split (column
pruning makes that a metadata read for a plain Parquet scan) and only one
number per task is shuffled. (``limit(n + 1).count()`` would look cheaper but
plans as a per-task limit feeding one single-partition task, which on a large
table funnels up to n rows from every task into it.) Beyond the bound the
join is left to the planner (sort-merge or AQE's own runtime switch), so a
catalog that grows with the data never lands whole in every executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Row bound under which a dimension side is broadcast.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000

_BROADCASTABLE_RIGHT = {"inner", "left", "leftouter", "left_outer", "left_anti", "leftanti",
                        "anti", "left_semi", "leftsemi", "semi", "cross"}


def is_small(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> bool:
    """True when ``df`` provably has at most ``max_rows`` rows."""
    return df.count() <= max_rows


def join_small(left: DataFrame, right: DataFrame, on, how: str = "left",
               max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Join ``right`` (the dimension side) into ``left``; broadcast it only
    when its size is checked to be under the bound and the join kind keeps
    the right side as build side."""
    if how.lower() in _BROADCASTABLE_RIGHT and is_small(right, max_rows):
        right = F.broadcast(right)
    return left.join(right, on, how)
