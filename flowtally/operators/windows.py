"""Running values over the hourly records (W1, W4, W5 batch side).

No ordered window here runs over raw rows or over a whole series: every
window partition holds at most a few days of hourly rows of one series, so a
partition's size is bounded by the window length, not by the data volume or
by how skewed the series are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtally.fixed import HOURS_PER_DAY, ROLLING_HOURS
from flowtally.functions.scalar import mean_of
from flowtally.functions.time import hour_index, hour_index_to_string
from flowtally.operators.joins import join_on

RECORD_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def cumulative_curve(hourly_rec: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Running daily total, restarting each date, own hour included.

    Output ``(*series, date, hour, cumulative_traffic bigint, is_holiday)``;
    window partitions are (series, date): at most 24 rows each.
    """
    w = (Window.partitionBy(*series, "date").orderBy("hour")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return hourly_rec.select(
        *series, "date", "hour",
        F.sum("traffic").over(w).cast("long").alias("cumulative_traffic"),
        "is_holiday")


def rolling_mean(hourly_rec: DataFrame, series: Sequence[str] = (),
                 hours: int = ROLLING_HOURS) -> DataFrame:
    """Trailing mean over the hourly records of ``(t - hours, t]``.

    Output ``(*series, current_time, window_start, avg_traffic, data_count)``
    with one row per hourly record t; ``window_start`` is t - (hours-1) h,
    ``data_count`` the number of hourly records in the window.

    Plan: each row is copied to the day buckets whose outputs can see it
    (its own day, plus the next day(s) as a halo), then a range window runs
    per (series, day bucket).  Copies per row are 1 + ceil((hours-1)/24), and
    a window partition holds at most one day plus its halo -- never a whole
    series.
    """
    span = hours - 1
    anchors = F.sequence(F.floor(F.col("hour_idx") / HOURS_PER_DAY),
                         F.floor((F.col("hour_idx") + span) / HOURS_PER_DAY))
    spread = hourly_rec.select(*series, "hour_idx", "traffic",
                               F.explode(anchors).alias("_bucket"))
    w = (Window.partitionBy(*series, "_bucket").orderBy("hour_idx")
         .rangeBetween(-span, Window.currentRow))
    return (spread
            .select(*series, "hour_idx", "_bucket",
                    F.sum("traffic").over(w).alias("_s"),
                    F.count("traffic").over(w).alias("_n"))
            .where(F.col("_bucket") == F.floor(F.col("hour_idx") / HOURS_PER_DAY))
            .select(*series,
                    hour_index_to_string(F.col("hour_idx")).alias("current_time"),
                    hour_index_to_string(F.col("hour_idx") - span).alias("window_start"),
                    mean_of(F.col("_s"), F.col("_n")).alias("avg_traffic"),
                    F.col("_n").cast("int").alias("data_count")))


def rolling_records(clean_df: DataFrame, series: Sequence[str] = (),
                    hours: int = ROLLING_HOURS) -> DataFrame:
    """W4 at every record: mean over the records of ``(t - hours, t]``.

    Output ``(*series, current_time, window_start, traffic, avg_traffic,
    data_count)`` with one row for each clean record ``(*series, ts, traffic)``;
    records of one time see each other.

    Plan: the window of a record of hour h is the whole hours ``h - hours`` to
    ``h - 1``, less the records of hour ``h - hours`` that have left it, plus
    the records of hour h up to t.  Whole hours are a range window over hourly
    sums (day halo, as in :func:`rolling_mean`).  Each record enters its own
    hour and leaves, ``hours`` later, that hour: two copies, summed up in the
    order of time within one (series, hour), so a window partition holds an
    hour's records and those of the hour that leaves, however many records the
    series has.
    """
    return records_by_hour(clean_df, series, hours).drop("_hour")


def records_by_hour(clean_df: DataFrame, series: Sequence[str] = (),
                    hours: int = ROLLING_HOURS) -> DataFrame:
    """:func:`rolling_records` with each record's hour index, ``_hour``."""
    hour = hour_index(F.col("ts"))
    rec = clean_df.select(*series, "ts", "traffic", hour.alias("_hour"))
    sums = rec.groupBy(*series, "_hour").agg(F.sum("traffic").alias("_s"), F.count(F.lit(1)).alias("_n"))
    day = F.floor(F.col("_hour") / HOURS_PER_DAY)
    spread = sums.withColumn("_bucket", F.explode(F.sequence(
        day, F.floor((F.col("_hour") + hours) / HOURS_PER_DAY))))
    before = Window.partitionBy(*series, "_bucket").orderBy("_hour").rangeBetween(-hours, -1)
    whole = (spread.withColumns({"_whole_s": F.sum("_s").over(before), "_whole_n": F.sum("_n").over(before)})
             .where(F.col("_bucket") == day).select(*series, "_hour", "_whole_s", "_whole_n"))
    enters = rec.select(*series, "_hour", "ts", "traffic", F.lit(1).alias("_sign"))
    leaves = rec.select(*series, (F.col("_hour") + hours).alias("_hour"),
                        (F.col("ts") + F.expr(f"interval {hours} hours")).alias("ts"), "traffic",
                        F.lit(-1).alias("_sign"))
    upto = Window.partitionBy(*series, "_hour").orderBy("ts")       # equal times are peers
    moved = (enters.unionByName(leaves)
             .withColumns({"_s": F.sum(F.col("_sign") * F.col("traffic")).over(upto),
                           "_n": F.sum("_sign").over(upto)}).where(F.col("_sign") == 1))
    known = join_on(moved, whole, [*series, "_hour"])
    total = F.coalesce("_whole_s", F.lit(0)) + F.col("_s")
    count = F.coalesce("_whole_n", F.lit(0)) + F.col("_n")
    return known.select(
        *series, "_hour", F.date_format("ts", RECORD_TIME).alias("current_time"),
        F.date_format(F.col("ts") - F.expr(f"interval {hours} hours"), RECORD_TIME).alias("window_start"),
        "traffic", mean_of(total, count).alias("avg_traffic"), count.cast("int").alias("data_count"))


def running_day_mean(hourly_rec: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """W5 (batch twin): mean of the day's hourly records so far, per hour."""
    w = (Window.partitionBy(*series, "date").orderBy("hour")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return hourly_rec.select(
        *series,
        F.col("date_time").alias("current_time"),
        F.concat(F.col("date"), F.lit(" 00:00:00")).alias("window_start"),
        mean_of(F.sum("traffic").over(w), F.count("traffic").over(w)).alias("avg_traffic"),
        F.count("traffic").over(w).cast("int").alias("data_count"))
