"""Consistency checks between the batch and the stream results (V1-V8).

Each check is a function of result DataFrames and returns a DataFrame; the
literal dates, hour 23 and thresholds of the reference are parameters.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.fixed import (DAY_TYPE_HOLIDAY, DAY_TYPE_ORDINARY, ENDPOINT_HOUR, HIGH_ALERT,
                             HIGH_RATIO, LOW_ALERT, LOW_RATIO, NORMAL)
from flowtally.functions.scalar import abs_error, abs_error_pct, pct_diff, safe_div
from flowtally.operators.aggregates import count_by, flag_sum, row_count
from flowtally.operators.joins import join_on, unique_rows


def holiday_diff(baseline: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """V1: ordinary vs holiday baseline per hour and percent difference.

    The reference self-joins the baseline on hour; as (series, is_holiday,
    hour) is unique in A1's output, one grouped pass gives the same rows
    without a join.  Hours lacking either side are left out (inner join).
    """
    ordinary = F.max(F.when(F.col("is_holiday") == 0, F.col("avg_traffic")))
    holiday = F.max(F.when(F.col("is_holiday") == 1, F.col("avg_traffic")))
    return (baseline.groupBy(*series, "hour")
            .agg(ordinary.alias("non_holiday_baseline"), holiday.alias("holiday_baseline"))
            .where(F.col("non_holiday_baseline").isNotNull()
                   & F.col("holiday_baseline").isNotNull())
            .select(*series, "hour", "non_holiday_baseline", "holiday_baseline",
                    pct_diff(F.col("holiday_baseline"),
                             F.col("non_holiday_baseline")).alias("diff_percent"))
            .orderBy(*series, "hour"))


def alert_distribution(alert_rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """V2: number of alert rows per class."""
    return count_by(alert_rows, [*by, "alert_status"], "record_count")


def _with_baseline(alert_rows: DataFrame, baseline: DataFrame, series: Sequence[str],
                   status: str) -> DataFrame:
    keys = [*series, "is_holiday", "hour"]
    return join_on(alert_rows.where(F.col("alert_status") == status).select(*keys, "traffic"),
                   unique_rows(baseline, keys, "avg_traffic"), keys)


def check_high(alert_rows: DataFrame, baseline: DataFrame, series: Sequence[str] = (),
               high: float = HIGH_RATIO) -> DataFrame:
    """V3: HIGH_ALERT rows whose ratio is below ``high`` (expect 0)."""
    j = _with_baseline(alert_rows, baseline, series, HIGH_ALERT)
    return row_count(j.where(safe_div(F.col("traffic"), F.col("avg_traffic")) < high),
                     "invalid_count")


def check_low(alert_rows: DataFrame, baseline: DataFrame, series: Sequence[str] = (),
              low: float = LOW_RATIO) -> DataFrame:
    """V4: LOW_ALERT rows whose ratio is above ``low`` (expect 0)."""
    j = _with_baseline(alert_rows, baseline, series, LOW_ALERT)
    return row_count(j.where(safe_div(F.col("traffic"), F.col("avg_traffic")) > low),
                     "invalid_count")


def check_normal(alert_rows: DataFrame, baseline: DataFrame, series: Sequence[str] = (),
                 high: float = HIGH_RATIO, low: float = LOW_RATIO) -> DataFrame:
    """V5: NORMAL rows split by where their ratio lies."""
    j = _with_baseline(alert_rows, baseline, series, NORMAL)
    ratio = safe_div(F.col("traffic"), F.col("avg_traffic"))
    return j.agg(F.count(F.lit(1)).alias("total_normal"),
                 flag_sum(ratio < low).alias("below_low_threshold"),
                 flag_sum(ratio > high).alias("above_high_threshold"),
                 flag_sum(ratio.between(low, high)).alias("within_range"))


def check_endpoint(totals: DataFrame, curve: DataFrame, series: Sequence[str] = (),
                   endpoint_hour: int | None = ENDPOINT_HOUR,
                   dates: Iterable[str] | None = None) -> DataFrame:
    """V6: the curve's end value against the daily total (diff expect 0).

    ``endpoint_hour=None`` takes each day's last hour present instead of a
    fixed hour.  The day type label follows the total's holiday flag, which
    is one pass over both days instead of a UNION ALL of two scans.
    """
    if endpoint_hour is None:
        ends = (curve.groupBy(*series, "date")
                .agg(F.max_by("cumulative_traffic", "hour").alias("stream_final")))
    else:
        ends = (curve.where(F.col("hour") == endpoint_hour)
                .select(*series, "date", F.col("cumulative_traffic").alias("stream_final")))
    if dates is not None:
        keep = sorted(set(dates))
        totals = totals.where(F.col("date").isin(keep))
        ends = ends.where(F.col("date").isin(keep))
    return (join_on(totals, ends, [*series, "date"])
            .select(*series, "date",
                    F.when(F.col("is_holiday") == 1, DAY_TYPE_HOLIDAY)
                     .otherwise(DAY_TYPE_ORDINARY).alias("day_type"),
                    F.col("total_daily_traffic").alias("batch_total"),
                    "stream_final",
                    (F.col("total_daily_traffic") - F.col("stream_final")).alias("diff")))


def endpoint_coverage(totals: DataFrame, curve: DataFrame, series: Sequence[str] = (),
                      endpoint_hour: int | None = ENDPOINT_HOUR) -> DataFrame:
    """What V6's inner join cannot show: how many (series, date) have both a
    total and a curve end, a total alone (the stream lost the day, or its last
    hour), or a curve end alone.  One row."""
    ends = curve if endpoint_hour is None else curve.where(F.col("hour") == endpoint_hour)
    sides = (totals.select(*series, "date", F.lit(1).alias("t"), F.lit(0).alias("e"))
             .unionByName(ends.select(*series, "date", F.lit(0).alias("t"), F.lit(1).alias("e")))
             .groupBy(*series, "date").agg(F.max("t").alias("t"), F.max("e").alias("e")))
    return sides.agg(F.count_if((F.col("t") == 1) & (F.col("e") == 1)).alias("both_sides"),
                     F.count_if(F.col("e") == 0).alias("totals_without_end"),
                     F.count_if(F.col("t") == 0).alias("ends_without_total"))


def check_convergence(rolling: DataFrame, daily_avg: DataFrame, series: Sequence[str] = (),
                      dates: Iterable[str] | None = None) -> DataFrame:
    """V7: rolling mean vs the batch daily mean of its date, with errors.

    Joined on the computed key ``DATE(current_time) = date``.
    """
    r = rolling.select(*series, "current_time", F.to_date("current_time").alias("_day"),
                       F.col("avg_traffic").alias("stream_rolling_avg"))
    d = daily_avg.select(*series, F.to_date("date").alias("_day"),
                         F.col("avg_daily_traffic").alias("batch_daily_avg"))
    if dates is not None:
        keep = [F.to_date(F.lit(x)) for x in sorted(set(dates))]
        r, d = r.where(F.col("_day").isin(keep)), d.where(F.col("_day").isin(keep))
    return (join_on(r, d, [*series, "_day"])
            .select(*series, "current_time", "stream_rolling_avg", "batch_daily_avg",
                    abs_error(F.col("stream_rolling_avg"), F.col("batch_daily_avg")).alias("error"),
                    abs_error_pct(F.col("stream_rolling_avg"),
                                  F.col("batch_daily_avg")).alias("error_pct"))
            .orderBy(*series, "current_time"))


def import_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """V8: ``COUNT(*)`` of each imported table as (table_name, row_count)."""
    parts = [row_count(df).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def import_check(before: Mapping[str, DataFrame], after: Mapping[str, DataFrame]) -> DataFrame:
    """V8 as a check: each table's rows before the write and as read back, and
    how many differ in either direction (as multisets, values included)."""
    out = None
    for name, df in before.items():
        back = after[name].select(*df.columns)
        sides = (df.withColumn("_n", F.lit(1)).unionByName(back.withColumn("_n", F.lit(-1)))
                 .groupBy(*df.columns).agg(F.sum("_n").alias("_n"),
                                           F.count_if(F.col("_n") == 1).alias("_before"),
                                           F.count_if(F.col("_n") == -1).alias("_after")))
        part = sides.agg(F.coalesce(F.sum("_before"), F.lit(0)).alias("rows_before"),
                         F.coalesce(F.sum("_after"), F.lit(0)).alias("rows_after"),
                         F.coalesce(F.sum(F.abs("_n")), F.lit(0)).alias("rows_different")).select(
                             F.lit(name).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def preview(df: DataFrame, n: int = 10, order_by: Sequence[str] | None = None) -> DataFrame:
    """A look at ``n`` rows (``SELECT * ... LIMIT n``).

    Without ``order_by`` which rows come back is not defined (as in SQL);
    with it, this is a top-n (``TakeOrderedAndProject``).
    """
    return (df.orderBy(*order_by) if order_by else df).limit(n)
