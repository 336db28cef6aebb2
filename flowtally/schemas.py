"""Declared result schemas (K5) of the six result tables.

Column order is the DDL order; VARCHAR lengths ride along as field metadata
and are enforced by :func:`conform`.  Series columns, when present, are kept
in front of the declared ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _varchar(name: str, n: int) -> T.StructField:
    return T.StructField(name, T.StringType(), True, {"varchar": n})


def _f(name: str, t: T.DataType) -> T.StructField:
    return T.StructField(name, t, True)


RESULT_SCHEMAS: dict[str, T.StructType] = {
    "batch_hourly_baseline": T.StructType([
        _f("is_holiday", T.IntegerType()), _f("hour", T.IntegerType()),
        _f("avg_traffic", T.DoubleType())]),
    "batch_daily_average": T.StructType([
        _varchar("date", 20), _f("is_holiday", T.IntegerType()),
        _f("avg_daily_traffic", T.DoubleType())]),
    "batch_daily_total": T.StructType([
        _varchar("date", 20), _f("is_holiday", T.IntegerType()),
        _f("total_daily_traffic", T.LongType())]),
    "flink_alert_result": T.StructType([
        _varchar("date_time", 30), _f("traffic", T.IntegerType()),
        _f("baseline", T.DoubleType()), _f("is_holiday", T.IntegerType()),
        _f("hour", T.IntegerType()), _varchar("alert_status", 10)]),
    "flink_rolling_avg_result": T.StructType([
        _varchar("current_time", 50), _varchar("window_start", 50),
        _f("avg_traffic", T.DoubleType()), _f("data_count", T.IntegerType())]),
    "flink_cumulative_result": T.StructType([
        _varchar("date", 20), _f("hour", T.IntegerType()),
        _f("cumulative_traffic", T.LongType()), _f("is_holiday", T.IntegerType())]),
}

# The clean hourly record.
CLEAN_SCHEMA = T.StructType([
    _f("date_time", T.StringType()), _f("date", T.StringType()), _f("hour", T.IntegerType()),
    _f("is_holiday", T.IntegerType()), _f("traffic", T.LongType())])


def result_schema(table: str, series: Sequence[T.StructField] = ()) -> T.StructType:
    return T.StructType(list(series) + list(RESULT_SCHEMAS[table].fields))


def conform(df: DataFrame, table: str, series: Sequence[str] = ()) -> DataFrame:
    """Select ``series`` + the declared columns in DDL order with their types.

    A string longer than its VARCHAR length fails the job (like a strict
    database insert) instead of being silently cut.
    """
    cols = [F.col(s) for s in series]
    for field in RESULT_SCHEMAS[table].fields:
        c = F.col(field.name).cast(field.dataType)
        n = field.metadata.get("varchar")
        if n is not None:
            c = F.when(c.isNull() | (F.length(c) <= n), c).otherwise(
                F.raise_error(F.lit(f"{table}.{field.name} longer than VARCHAR({n})"))
            ).cast(field.dataType)
        cols.append(c.alias(field.name))
    return df.select(*cols)
