"""Dictionary lookups and ordered rule chains (SC-07, SC-09..11, SC-14..16,
SC-22, SC-23, SC-25, SC-28..35, SC-37, and the UDF surface of §2.14).

``map_lookup`` replaces per-row Python dictionary UDFs with a literal map
that stays inside whole-stage codegen. For a catalog too big to inline it,
use ``lookup_join`` (a size-checked broadcast join).
"""

from __future__ import annotations

from typing import Any, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.operators.broadcast import join_small


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def map_lookup(c, mapping: dict, default: Any = None, normalize: bool = False) -> Column:
    """Value of ``mapping[c]``; missing key or null -> ``default``.

    ``normalize`` compares on trimmed upper-case text.
    """
    key = _c(c)
    if normalize:
        key = F.upper(F.trim(key.cast("string")))
        mapping = {str(k).strip().upper(): v for k, v in mapping.items()}
    entries = []
    for k, v in mapping.items():
        entries += [F.lit(k), F.lit(v)]
    value = F.try_element_at(F.create_map(*entries), key)
    return value if default is None else F.coalesce(value, F.lit(default))


def lookup_join(df: DataFrame, key_col: str, catalog: DataFrame, catalog_key: str,
                value_cols: Sequence[str], max_rows: int = 1_000_000) -> DataFrame:
    """Left join a catalog, broadcast only when its row count is proven small."""
    cat = catalog.select(F.col(catalog_key).alias("__lk"), *value_cols)
    return join_small(df, cat, F.col(key_col) == F.col("__lk"), "left", max_rows).drop("__lk")


def _cond(col: Column, op: str, value) -> Column:
    if op == "eq":
        return col == F.lit(value)
    if op == "in":
        return col.isin(*list(value))
    if op == "contains":
        return col.contains(value)
    if op == "startswith":
        return col.startswith(value)
    if op == "endswith":
        return col.endswith(value)
    if op == "like":
        return col.like(value)
    if op == "rlike":
        return col.rlike(value)
    if op == "null":
        return col.isNull()
    raise ValueError(f"unknown rule operator {op!r}")


def rule_chain(c, rules: Iterable, default: Any = None) -> Column:
    """Ordered categorisation: the first matching rule gives the label.

    A rule is ``(op, value, label)`` or ``([(op, value), ...], label)`` for a
    conjunction. ``label`` may be a Column. No match -> ``default`` (null
    when None).
    """
    col = _c(c)
    expr = None
    for rule in rules:
        if len(rule) == 3:
            cond = _cond(col, rule[0], rule[1])
            label = rule[2]
        else:
            parts, label = rule
            cond = None
            for op, value in parts:
                p = _cond(col, op, value)
                cond = p if cond is None else (cond & p)
        lab = label if isinstance(label, Column) else F.lit(label)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def in_list_flag(c, values: Iterable, negate: bool = False) -> Column:
    """SC-09 / SC-36: 1 when (not) in the list, else 0; null -> 0."""
    hit = F.coalesce(_c(c).isin(*list(values)), F.lit(False))
    if negate:
        hit = ~hit
    return hit.cast("int")


def in_list_and_positive(c, values: Iterable, amount) -> Column:
    """SC-10: 1 when listed and the amount is above zero."""
    return F.when(_c(c).isin(*list(values)) & (_c(amount) > 0), 1).otherwise(0).cast("int")


def prefix_or_list_flag(c, values: Iterable = (), prefixes: Iterable[str] = ()) -> Column:
    """SC-22: 1 when the value is listed or starts with a listed prefix."""
    col = _c(c)
    cond = F.lit(False)
    vals = list(values)
    if vals:
        cond = cond | F.coalesce(col.isin(*vals), F.lit(False))
    for p in prefixes:
        cond = cond | F.coalesce(col.like(f"{p}%"), F.lit(False))
    return cond.cast("int")


def missing_marker_to(c, markers: Iterable[str], replacement: str) -> Column:
    """SC-16: trimmed value in ``markers`` (or null) -> ``replacement``."""
    t = F.trim(_c(c))
    return F.when(t.isNull() | t.isin(*list(markers)), F.lit(replacement)).otherwise(t)


def last_meaningful(*cols, min_length: int = 2) -> Column:
    """SC-30: the last of the parts whose length is at least ``min_length``;
    the first part when none of the later ones qualifies."""
    later = [F.when(F.length(_c(x)) >= min_length, _c(x)) for x in reversed(cols[1:])]
    return F.coalesce(*later, _c(cols[0]))


def pick_by_code(code, first_code, first_value, second_code, second_value,
                 cast: str | None = None) -> Column:
    """SC-33 / SC-34: choose one of two columns by a code; other codes -> null."""
    expr = F.when(_c(code) == F.lit(first_code), _c(first_value)) \
        .when(_c(code) == F.lit(second_code), _c(second_value))
    return expr.cast(cast) if cast else expr


def compound_key(*parts, sep: str = "_") -> Column:
    """SC-35 / AG-08: key built from several lookups or columns."""
    return F.concat_ws(sep, *[_c(p) for p in parts])
