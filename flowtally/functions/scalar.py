"""Scalar helpers (X1-X7): division, percent difference, rounding.

MySQL's ``/`` yields NULL on a zero divisor; Spark 4 in ANSI mode raises, so
every ratio here goes through ``try_divide``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    """Fractional division, NULL when the divisor is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def pct_diff(new: Column, old: Column, digits: int = 2) -> Column:
    """``ROUND((new - old) / old * 100, digits)``."""
    return F.round(safe_div(new - old, old) * 100, digits)


def abs_error(a: Column, b: Column, digits: int = 2) -> Column:
    """``ROUND(ABS(a - b), digits)``."""
    return F.round(F.abs(a - b), digits)


def abs_error_pct(a: Column, b: Column, digits: int = 2) -> Column:
    """``ROUND(ABS(a - b) / b * 100, digits)``."""
    return F.round(safe_div(F.abs(a - b), b) * 100, digits)


def mean_of(sum_col: Column, count_col: Column) -> Column:
    """Exact mean: an exact integer sum divided once by the count."""
    return safe_div(sum_col, count_col)
