"""Currency expressions (SC-17..SC-21).

Amounts are kept as decimals so conversions and the sums built on them are
exact and do not depend on the order rows are added in (S-10).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_by_currency(value, currency, codes: dict[str, object], alias_fmt: str = "{value}_{name}",
                      value_name: str = "amount") -> list[Column]:
    """SC-17: one column per currency, the value where the row has that
    currency and 0 elsewhere."""
    return [F.when(_c(currency) == F.lit(code), _c(value)).otherwise(F.lit(0))
              .alias(alias_fmt.format(value=value_name, name=name))
            for name, code in codes.items()]


def to_home_currency(currency, amount, rate, home_code=1) -> Column:
    """SC-18: amount in home currency: as is for the home code, else x rate
    (null when the rate is missing, S-08)."""
    return F.when(_c(currency) == F.lit(home_code), _c(amount)).otherwise(_c(amount) * _c(rate))


def currency_views(currency, amount, rate, codes: dict[str, object], home_code=1,
                   value_name: str = "amount") -> list[Column]:
    """SC-19: SC-17 split plus the SC-18 unified home amount."""
    return split_by_currency(amount, currency, codes, value_name=value_name) + [
        to_home_currency(currency, amount, rate, home_code).alias(f"{value_name}_unified")]


def convert(amount, rate, cast: str | None = None) -> Column:
    """SC-20: amount x rate with an optional cast."""
    out = _c(amount) * _c(rate)
    return out.cast(cast) if cast else out


def split_home_amount(currency, home_amount, rate, codes: dict[str, object], home_code=1,
                      value_name: str = "amount") -> list[Column]:
    """SC-21: per-currency split when the source is already in home currency:
    the foreign column is home / rate (null-safe divide)."""
    out = []
    for name, code in codes.items():
        v = _c(home_amount) if code == home_code else F.try_divide(_c(home_amount), _c(rate))
        out.append(F.when(_c(currency) == F.lit(code), v).otherwise(F.lit(0))
                   .alias(f"{value_name}_{name}"))
    return out


def money(c, scale: int = 2, precision: int = 19) -> Column:
    """Round to ``scale`` and cast to ``decimal(precision, scale)``."""
    return F.round(_c(c), scale).cast(f"decimal({precision},{scale})")
