"""Day-level holiday flag (P3) as a pure column expression.

A rule calendar or a list of dates becomes one boolean expression on the
date, so flagging needs no join, no broadcast and stays inside whole-stage
codegen.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowtally.fixed import FIXED_DATE_HOLIDAYS, WEEKDAY_RULE_HOLIDAYS


def _nth_weekday_days(nth: int) -> tuple[int, int]:
    """Day-of-month range holding the nth (or last, -1) weekday of a month."""
    if nth == -1:
        return 25, 31  # the last weekday of a 31-day month (May)
    return 7 * (nth - 1) + 1, 7 * nth


def us_federal_holiday(date_col: Column) -> Column:
    """1 when the date is a US federal holiday (not shifted for weekends)."""
    month, day = F.month(date_col), F.dayofmonth(date_col)
    # Spark's dayofweek: 1 = Sunday ... 7 = Saturday; rules use 0 = Monday.
    weekday = F.pmod(F.dayofweek(date_col) + 5, F.lit(7))
    cond = F.lit(False)
    for m, d in FIXED_DATE_HOLIDAYS:
        cond = cond | ((month == m) & (day == d))
    for m, wd, nth in WEEKDAY_RULE_HOLIDAYS:
        lo, hi = _nth_weekday_days(nth)
        cond = cond | ((month == m) & (weekday == wd) & day.between(lo, hi))
    return F.when(cond, 1).otherwise(0)


def listed_holiday(date_col: Column, dates: Iterable[str | dt.date]) -> Column:
    """1 when the date is in a driver-side list (a bounded literal set)."""
    days = sorted({dt.date.fromisoformat(str(d)) for d in dates})
    if not days:
        return F.lit(0)
    return F.when(date_col.isin([F.lit(d) for d in days]), 1).otherwise(0)


def holiday_flag(date_col: Column, holidays="us_federal") -> Column:
    """Dispatch: ``"us_federal"``, an iterable of dates, or ``None`` (no holidays)."""
    if holidays is None:
        return F.lit(0)
    if isinstance(holidays, str):
        if holidays != "us_federal":
            raise ValueError(f"unknown holiday calendar {holidays!r}")
        return us_federal_holiday(date_col)
    return listed_holiday(date_col, holidays)
