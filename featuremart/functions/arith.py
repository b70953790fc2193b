"""Row-wise arithmetic over column lists (SC-08, AG-07, AG-10, safe ratios)."""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sum_fields(cols: Iterable) -> Column:
    """SC-08: null-propagating sum of several columns."""
    return reduce(add, [_c(c) for c in cols])


def sum_fields_nullsafe(cols: Iterable) -> Column:
    """AG-07 / AG-10: sum treating null as 0."""
    return reduce(add, [F.coalesce(_c(c), F.lit(0)) for c in cols])


def nullsafe_sum(cols: Iterable, clamp_negative: bool = False) -> Column:
    """JN-04 on columns already side by side: null only when every input is
    null, negatives optionally clamped to 0."""
    cs = [_c(c) for c in cols]
    total = F.when(reduce(lambda a, b: a & b, [c.isNull() for c in cs]), F.lit(None)) \
        .otherwise(sum_fields_nullsafe(cs))
    return F.when(total < 0, F.lit(0)).otherwise(total) if clamp_negative else total


def matching_columns(columns: Iterable[str], fixed: str, variants: Iterable[str] = ()) -> list[str]:
    """Columns whose name holds ``fixed`` and (if given) any of ``variants``."""
    vs = list(variants)
    return [c for c in columns if fixed in c and (not vs or any(v in c for v in vs))]


def safe_ratio(num, den) -> Column:
    """Ratio that is null unless the divisor is a positive number."""
    return F.when(_c(den) > 0, F.try_divide(_c(num), _c(den)))
