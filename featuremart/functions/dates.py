"""Date expressions (SC-01..03, SC-24, SC-27, PRJ-04, PRJ-12, QA-01/06).

All built from Spark built-ins; ``try_*`` forms keep ANSI mode from
raising on dirty input (S-12).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_start(d) -> Column:
    return F.trunc(F.to_date(_c(d)), "month")


def month_end(d) -> Column:
    return F.last_day(F.to_date(_c(d)))


def period_int(d) -> Column:
    """PRJ-04: ``yyyyMM`` as int."""
    return F.date_format(_c(d), "yyyyMM").cast("int")


def whole_years_between(start, end, null_as_zero: bool = False) -> Column:
    """SC-01: whole years from ``start`` to ``end``; negative -> 0.

    The reference also maps unknown dates to 0; that is kept behind
    ``null_as_zero`` (S-14), default keeps null.
    """
    m = F.months_between(F.to_date(_c(end)), F.to_date(_c(start)))
    if null_as_zero:
        m = F.coalesce(m, F.lit(0.0))
    # ``greatest`` skips nulls, so an unknown date is kept null explicitly
    return F.when(m.isNotNull(), F.floor(F.greatest(m, F.lit(0.0)) / 12)).cast("int")


def whole_months_between(reference, other) -> Column:
    """SC-02: truncated whole months; null or negative -> 0."""
    m = F.months_between(F.to_date(_c(reference)), F.to_date(_c(other)))
    return F.coalesce(F.greatest(m, F.lit(0.0)).cast("int"), F.lit(0))


def days_between(start, end) -> Column:
    """SC-03: day difference ``end - start``; null stays null."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


def next_payment_date(statement_date, card_type=None, early_types=(), early_days: int = 5,
                      earlier_types=(), earlier_days: int = 6) -> Column:
    """SC-24: same day next month (clamped to month end, S-13), moved
    ``early_days`` / ``earlier_days`` back for the listed card types."""
    nxt = F.add_months(F.to_date(_c(statement_date)), 1)
    if card_type is None:
        return nxt
    ct = _c(card_type)
    expr = nxt
    if earlier_types:
        expr = F.when(ct.isin(*earlier_types), F.date_sub(nxt, earlier_days)).otherwise(expr)
    if early_types:
        expr = F.when(ct.isin(*early_types), F.date_sub(nxt, early_days)).otherwise(expr)
    return expr


def parse_day_first_date(text, min_year: int = 1900, max_year: int | Column | None = None
                         ) -> Column:
    """SC-27: 8-digit text date, day-first then month-first; kept only when
    the year lies in ``[min_year, max_year]`` (default: current year)."""
    t = F.trim(_c(text).cast("string"))
    hi = F.year(F.current_date()) if max_year is None else (
        max_year if isinstance(max_year, Column) else F.lit(max_year))

    def ok(d):
        return F.when((F.year(d) >= min_year) & (F.year(d) <= hi), d)

    eight = F.length(t) == 8
    day_first = F.try_to_date(t, "ddMMyyyy")
    month_first = F.try_to_date(t, "MMddyyyy")
    return F.when(eight, F.coalesce(ok(day_first), ok(month_first)))


def last_closed_month_end(as_of) -> Column:
    """QA-15 / CL-42: month end of the month before ``as_of``."""
    return F.last_day(F.add_months(F.to_date(_c(as_of)), -1))


def previous_month_range(as_of: _dt.date | None = None) -> tuple[_dt.date, _dt.date]:
    """QA-15 / default run window: first and last day of the calendar month
    before ``as_of`` (today by default). Driver-side date arithmetic only."""
    as_of = as_of or _dt.date.today()
    end = as_of.replace(day=1) - _dt.timedelta(days=1)
    return end.replace(day=1), end


def held_back_range(start: _dt.date, as_of: _dt.date | None = None, lag_days: int = 2
                    ) -> tuple[_dt.date, _dt.date]:
    """QA-12: days to check, the end held back ``lag_days`` before ``as_of``."""
    as_of = as_of or _dt.date.today()
    return start, as_of - _dt.timedelta(days=lag_days)
