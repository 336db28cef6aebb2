"""Null-safe equi-joins on key columns.

Every result column is nullable, and a record whose series is NULL has a
baseline group of its own; ``=`` would drop such records from a join.  The
``<=>`` keys below still plan as equi-join keys (broadcast hash or
sort-merge), so nothing is lost in the plan either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_rows(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """``keys`` and ``column`` of ``df``; a key that repeats fails the job
    instead of multiplying the rows it is joined to."""
    once = F.when(F.count(F.lit(1)) == 1, F.max(column)).otherwise(
        F.raise_error(F.lit(f"{column}: more than one row for a key")).cast(df.schema[column].dataType))
    return df.groupBy(*keys).agg(once.alias(column))


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str],
            how: str = "inner") -> DataFrame:
    """``left JOIN right`` on ``left.k <=> right.k`` for each key, keeping one
    copy of each key column (the left one).  No side is hinted: Spark
    broadcasts one whose measured size is under its threshold."""
    keys = list(keys)
    renamed = right.select(*[F.col(k).alias(f"_rk_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(renamed[f"_rk_{k}"]) for k in keys]
    joined = left.join(renamed, cond, how)
    if how in ("left_anti", "left_semi", "anti", "semi"):
        return joined
    return joined.drop(*[f"_rk_{k}" for k in keys])
