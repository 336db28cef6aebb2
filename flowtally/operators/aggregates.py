"""Batch result tables.

Means are an exact integer sum divided once by a count, never a mean of
means, so they are independent of partitioning and equal in any engine.
All groupings are partial-aggregated map-side before their shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtally.functions.scalar import mean_of


def _rounded(col: Column, rounding: str | None) -> Column:
    if rounding is None:
        return col
    if rounding == "half_up":
        return F.round(col, 0)
    if rounding == "floor":
        return F.floor(col).cast("double")
    raise ValueError(f"unknown rounding {rounding!r}")


def hourly_baseline(rec: DataFrame, series: Sequence[str] = (),
                    rounding: str | None = None) -> DataFrame:
    """A1: mean traffic per (series, is_holiday, hour) -> ``avg_traffic``.

    At most 2 x 24 rows per series.  ``rounding`` = None | "half_up" | "floor"
    (the reference's exported baseline holds whole numbers).
    """
    return (rec.groupBy(*series, "is_holiday", "hour")
               .agg(F.sum("traffic").alias("_s"), F.count("traffic").alias("_n"))
               .select(*series, "is_holiday", "hour",
                       _rounded(mean_of(F.col("_s"), F.col("_n")), rounding).alias("avg_traffic")))


def _dated(rec: DataFrame, dates: Iterable[str] | None) -> DataFrame:
    if dates is None:
        return rec
    return rec.where(F.col("date").cast("string").isin(sorted(set(dates))))


def daily_average(rec: DataFrame, series: Sequence[str] = (),
                  dates: Iterable[str] | None = None) -> DataFrame:
    """A2: mean traffic over the records of each (series, date)."""
    return (_dated(rec, dates).groupBy(*series, "date", "is_holiday")
            .agg(F.sum("traffic").alias("_s"), F.count("traffic").alias("_n"))
            .select(*series, F.col("date").cast("string").alias("date"), "is_holiday",
                    mean_of(F.col("_s"), F.col("_n")).alias("avg_daily_traffic")))


def daily_total(rec: DataFrame, series: Sequence[str] = (),
                dates: Iterable[str] | None = None) -> DataFrame:
    """A3: total traffic per (series, date) as bigint; ``dates`` keeps chosen
    days (F4), default all."""
    return (_dated(rec, dates).groupBy(*series, "date", "is_holiday")
            .agg(F.sum("traffic").cast("long").alias("total_daily_traffic"))
            .select(*series, F.col("date").cast("string").alias("date"), "is_holiday",
                    "total_daily_traffic"))


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """A4: global ``COUNT(*)`` as a one-row table (0 on empty input)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def count_by(df: DataFrame, keys: Sequence[str], name: str = "record_count") -> DataFrame:
    """A5: ``SELECT k, COUNT(*) ... GROUP BY k``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def flag_sum(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` -- NULL over zero rows,
    unlike ``count_if``."""
    return F.sum(F.when(cond, 1).otherwise(0))
