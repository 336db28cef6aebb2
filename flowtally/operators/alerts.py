"""Baseline join and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.fixed import HIGH_RATIO, LOW_RATIO
from flowtally.functions.classify import alert_status
from flowtally.operators.joins import join_on, unique_rows


def join_baseline(rec: DataFrame, baseline: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Inner join of records with their baseline on (series, is_holiday, hour).

    The baseline grows with the number of series, so it is not hinted: it is
    broadcast when its measured size is under Spark's thresholds (static or
    adaptive); otherwise a shuffle join on the same keys runs (skew-split by
    AQE).  A baseline key that repeats fails the job.
    Records without a baseline row drop out, as in the reference's inner joins.
    """
    keys = [*series, "is_holiday", "hour"]
    side = unique_rows(baseline, keys, "avg_traffic").withColumnRenamed("avg_traffic", "baseline")
    return join_on(rec, side, keys)


def alerts(rec: DataFrame, baseline: DataFrame, series: Sequence[str] = (),
           high: float = HIGH_RATIO, low: float = LOW_RATIO) -> DataFrame:
    """L3: every record with its baseline and class, NORMAL included.

    Output ``(*series, date_time, traffic, baseline, is_holiday, hour,
    alert_status)`` -- the alert result table plus the series columns.
    """
    return join_baseline(rec, baseline, series).select(
        *series, "date_time", "traffic", "baseline", "is_holiday", "hour",
        alert_status(F.col("traffic"), F.col("baseline"), high, low).alias("alert_status"))


def unmatched_records(rec: DataFrame, baseline: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Records the inner baseline join drops (no baseline for their key), as
    a one-row count ``unmatched_records`` -- the metric beside the alerts."""
    keys = [*series, "is_holiday", "hour"]
    side = baseline.select(*keys)
    return (join_on(rec, side, keys, "left_anti")
            .agg(F.count(F.lit(1)).alias("unmatched_records")))
