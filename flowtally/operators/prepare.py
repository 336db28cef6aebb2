"""Cleaning and derivation.

``clean`` types the raw rows; ``hourly`` turns them into the hourly flow
records every other operator reads: one row per (series, date, hour) whose
``traffic`` is the sum over the hour.  Map-side partial aggregation makes the
hourly step skew-proof: a series holding a third of all rows is collapsed to
one row per hour and task before anything is shuffled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtally.fixed import DATETIME_FORMAT
from flowtally.functions.holidays import holiday_flag
from flowtally.functions.time import date_string, to_wall_clock

SeriesSpec = Sequence[str] | Mapping[str, Column | str]


def _series_columns(series: SeriesSpec) -> list[Column]:
    if isinstance(series, Mapping):
        return [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in series.items()]
    return [F.col(s) for s in series]


def series_names(series: SeriesSpec) -> list[str]:
    return list(series.keys()) if isinstance(series, Mapping) else list(series)


def clean(df: DataFrame, time_col: str, value: Column | str, series: SeriesSpec = (),
          time_format: str = DATETIME_FORMAT, flag: Column | None = None,
          time_range: tuple[str, str] | None = None,
          dates: Sequence[str] | None = None) -> DataFrame:
    """``(*series, ts timestamp_ntz, traffic bigint[, holiday_flag int])``.

    Rows whose time or value is NULL or unparseable are dropped: they cannot
    be placed on the hour grid.  ``time_range`` ``[start, end)`` is applied to
    the raw time column so that it reaches the scan as a pushed filter, and
    so are chosen ``dates`` (F4), one range each.
    ``flag`` is an optional per-row holiday marker (raw files mark only one row
    of a holiday); :func:`hourly` spreads it to the whole day.

    ``value`` becomes ``traffic`` as a bigint: traffic is a count, and whole
    numbers keep every sum and mean exact.  A cast truncates, so round a
    fractional value in the expression itself (e.g. ``round(value * 100)``).
    """
    raw_type = df.schema[time_col].dataType
    if time_range is not None:
        lo, hi = time_range
        df = df.where((F.col(time_col) >= F.lit(lo).cast(raw_type))
                      & (F.col(time_col) < F.lit(hi).cast(raw_type)))
    if dates is not None:
        df = df.where(_on_dates(time_col, raw_type, dates))
    value_col = F.col(value) if isinstance(value, str) else value
    cols = _series_columns(series) + [
        to_wall_clock(time_col, raw_type, time_format).alias("ts"),
        value_col.try_cast("long").alias("traffic"),
    ]
    if flag is not None:
        cols.append(flag.cast("int").alias("holiday_flag"))
    return df.select(*cols).where(F.col("ts").isNotNull() & F.col("traffic").isNotNull())


def rejected(df: DataFrame, time_col: str, value: Column | str,
             time_format: str = DATETIME_FORMAT) -> DataFrame:
    """The rows that :func:`clean` drops, whole, with ``reject_reason``
    (``time`` or ``value``): the quarantine table beside the clean one."""
    value_col = F.col(value) if isinstance(value, str) else value
    no_time = to_wall_clock(time_col, df.schema[time_col].dataType, time_format).isNull()
    no_value = value_col.try_cast("long").isNull()
    return (df.withColumn("reject_reason", F.when(no_time, "time").when(no_value, "value"))
            .where(F.col("reject_reason").isNotNull()))


def marked_days(clean_df: DataFrame) -> DataFrame:
    """The dates on which a row carries the holiday marker, as a calendar
    table: what the streams take as ``holidays`` when the raw file marks its
    own days."""
    return (clean_df.where(F.col("holiday_flag") == 1)
            .select(F.to_date("ts").alias("date")).distinct())


def _on_dates(time_col: str, raw_type, dates: Sequence[str]) -> Column:
    """The raw time column lies on one of ``dates``: ranges on the column as
    it is stored, which the scan can use; text compares as text."""
    cond = F.lit(False)
    for day in sorted({dt.date.fromisoformat(str(d)) for d in dates}):
        lo, hi = day.isoformat(), (day + dt.timedelta(days=1)).isoformat()
        cond = cond | ((F.col(time_col) >= F.lit(lo).cast(raw_type))
                       & (F.col(time_col) < F.lit(hi).cast(raw_type)))
    return cond


def _finish(df: DataFrame, series: list[str], holidays, has_flag: bool,
            date_as_string: bool = True) -> DataFrame:
    """Common columns of both grains; ``day`` is a DateType, ``hour`` an int."""
    if has_flag:
        # Day-level flag from a marker on some row(s) of the day: one small
        # aggregate per date, joined back (AQE broadcasts it by real size).
        days = df.groupBy("day").agg(F.max("holiday_flag").alias("is_holiday"))
        df = df.drop("holiday_flag").join(days, "day")
        flag = F.coalesce(F.col("is_holiday"), F.lit(0))
    elif isinstance(holidays, DataFrame):
        # A calendar table: one row per holiday date (distinct, so a repeated
        # date cannot multiply records), left-joined and defaulting to 0.
        # Not hinted: AQE broadcasts it by its real size.
        col = "date" if "date" in holidays.columns else holidays.columns[0]
        cal = (holidays.select(F.to_date(F.col(col)).alias("day")).distinct()
               .withColumn("_holiday", F.lit(1)))
        df = df.join(cal, "day", "left")
        flag = F.coalesce(F.col("_holiday"), F.lit(0))
    else:
        flag = holiday_flag(F.col("day"), holidays)
    return df.select(
        *series,
        (F.unix_date("day").cast("long") * 24 + F.col("hour")).alias("hour_idx"),
        F.col("date_time"),
        (date_string(F.col("day")) if date_as_string else F.col("day")).alias("date"),
        F.col("hour"),
        flag.cast("int").alias("is_holiday"),
        F.col("traffic"),
        *[c for c in ("n_records",) if c in df.columns],
    )


def hourly(clean_df: DataFrame, series: SeriesSpec = (), holidays="us_federal",
           combine: str = "sum") -> DataFrame:
    """P1-P3 on the hour grain.

    ``holidays``: ``"us_federal"``, a list of dates, a calendar DataFrame
    (a ``date`` column), or ``None``; a ``holiday_flag`` column from
    :func:`clean` takes precedence.

    Output: ``(*series, hour_idx, date_time, date, hour, is_holiday, traffic,
    n_records)``.  ``combine="sum"`` adds up the records of an hour (counts);
    ``combine="max"`` keeps one value for repeated measurement rows of the
    same hour (raw files that repeat a reading).
    """
    return hour_records(hour_sums(clean_df, series, combine), series_names(series), holidays)


def hour_records(grouped: DataFrame, series: Sequence[str] = (), holidays="us_federal") -> DataFrame:
    """The hourly records of hour sums ``(*series, day, hour, traffic,
    n_records[, holiday_flag])``: the last step of :func:`hourly`, for sums
    that are kept elsewhere (:mod:`flowtally.plans.incremental`)."""
    named = grouped.withColumn(
        "date_time", F.concat(date_string(F.col("day")), F.lit(" "),
                              F.lpad(F.col("hour").cast("string"), 2, "0"), F.lit(":00:00")))
    return _finish(named, list(series), holidays, "holiday_flag" in grouped.columns)


def hour_sums(clean_df: DataFrame, series: SeriesSpec = (), combine: str = "sum") -> DataFrame:
    """Clean records added up by hour: ``(*series, day, hour, traffic,
    n_records[, holiday_flag])``.  Sums of sums are the sums of all records,
    so parts of the input can be added up one after the other."""
    names = series_names(series)
    agg = {"sum": F.sum, "max": F.max}[combine]
    aggs = [agg("traffic").alias("traffic"), F.count(F.lit(1)).alias("n_records")]
    if "holiday_flag" in clean_df.columns:
        aggs.append(F.max("holiday_flag").alias("holiday_flag"))
    return (clean_df
            .groupBy(*names, F.to_date("ts").alias("day"), F.hour("ts").alias("hour"))
            .agg(*aggs))


def records(clean_df: DataFrame, series: SeriesSpec = (), holidays="us_federal") -> DataFrame:
    """P2-P3 on the record grain (no hourly roll-up), for per-record daily
    operators on tables such as orders or lineitem.

    Here ``date`` stays a DateType: grouping on it hashes an int per row
    instead of formatting a string per row; the daily results format the
    date once per output row.
    """
    names = series_names(series)
    has_flag = "holiday_flag" in clean_df.columns
    df = clean_df.select(
        *names, F.to_date("ts").alias("day"), F.hour("ts").alias("hour"),
        F.date_format("ts", DATETIME_FORMAT).alias("date_time"), "traffic",
        *(["holiday_flag"] if has_flag else []))
    return _finish(df, names, holidays, has_flag, date_as_string=False)


def record_stream(clean_df: DataFrame, series: SeriesSpec = (), holidays="us_federal") -> DataFrame:
    """The clean records one by one as the per-record alerts take them:
    (*series, date_time, date, hour, is_holiday, traffic)."""
    rec = records(clean_df, series, holidays)
    return rec.select(*series_names(series), "date_time", F.col("date").cast("string").alias("date"),
                      "hour", "is_holiday", "traffic")
