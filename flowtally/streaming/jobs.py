"""Stream results (L1, W2, W3, W5) as Structured Streaming plans.

Each function takes a *clean* streaming frame ``(*series, ts, traffic)``
(see :func:`flowtally.operators.prepare.clean`, which works on streams as-is)
and returns a :class:`StreamPlan`: the streaming DataFrame, its result key,
the output mode, and an optional per-micro-batch step.

State is bounded by the watermark: every stateful key carries an event-time
window, so state of closed windows is dropped.  ``mode="update"`` (default)
emits the current value of every key touched by a micro-batch -- early and
revisable; the sink keeps the last write per key
(:mod:`flowtally.streaming.sink`).  ``mode="append"`` emits each key once,
final, when the watermark has passed its window (no revisions, later).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtally.fixed import HIGH_RATIO, HOURS_PER_DAY, LOW_RATIO, ROLLING_HOURS
from flowtally.functions.holidays import holiday_flag
from flowtally.functions.scalar import mean_of
from flowtally.functions.time import (date_string, event_time, hour_index,
                                      hour_index_to_string, instant_hour_index)
from flowtally.operators.alerts import alerts as alerts_batch
from flowtally.operators.asof import alerts_asof
from flowtally.sources.stream import path_kind

DEFAULT_LATENESS = "1 hour"
MODES = ("update", "append")


def _mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return mode


@dataclass
class StreamPlan:
    frame: DataFrame
    keys: list[str]
    mode: str
    per_batch: Callable[[DataFrame], DataFrame] | None = None
    stateful: bool = True
    closes: Callable[[Column], Column] | None = None    # when the first window of a row of that ``ts`` ends


def replay_lateness(clean_batch: DataFrame) -> str:
    """The lateness under which a bounded replay of these rows loses none of
    them, in whatever files and order they come: the span of their times."""
    lo, hi = clean_batch.agg(F.min("ts"), F.max("ts")).first()
    hours = 1 if lo is None else int((hi - lo).total_seconds() // 3600) + 1
    return f"{hours} hours"


def with_end_marker(clean_stream: DataFrame, folder: str) -> DataFrame:
    """The stream and what is put into ``folder``: :func:`end_marker` rows
    move the watermark past the data, so that append mode closes every
    window of a bounded replay."""
    spark = clean_stream.sparkSession
    if path_kind(spark, folder) is None:
        spark.createDataFrame([], clean_stream.schema).write.parquet(folder)
    return clean_stream.unionByName(spark.readStream.schema(clean_stream.schema).parquet(folder))


def end_marker(clean_batch: DataFrame, folder: str, lateness: str, days: int = 10) -> None:
    """One row without series and traffic, ``days`` and the lateness after the
    last time of the data; its own windows stay open and are never emitted."""
    last = clean_batch.agg((F.max("ts") + F.expr(f"interval {days} days")
                            + F.expr(f"interval {lateness}")).alias("ts"))
    empty = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != "ts" else F.col("ts")
             for f in clean_batch.schema.fields]
    last.where(F.col("ts").isNotNull()).select(*empty).write.mode("append").parquet(folder)


def hour_end(ts: Column) -> Column:
    return event_time(F.date_trunc("hour", ts).cast("timestamp_ntz")) + F.expr("interval 1 hour")


def _day_end(ts: Column) -> Column:
    return event_time(F.to_date(ts).cast("timestamp_ntz")) + F.expr("interval 1 day")


def _combined(combine: str):
    """How the records of one hour become its traffic, as in the batch."""
    return {"sum": F.sum, "max": F.max}[combine]


def _flagged(frame: DataFrame, holidays, day: str = "day") -> DataFrame:
    """``frame`` with ``is_holiday`` of its day; a calendar table is joined as
    the static side."""
    if not isinstance(holidays, DataFrame):
        return frame.withColumn("is_holiday", holiday_flag(F.col(day), holidays).cast("int"))
    name = "date" if "date" in holidays.columns else holidays.columns[0]
    calendar = (holidays.select(F.to_date(F.col(name)).alias("_holiday")).distinct())
    return (frame.join(calendar, frame[day] == calendar["_holiday"], "left")
            .withColumn("is_holiday", F.col("_holiday").isNotNull().cast("int")).drop("_holiday"))


def with_event_time(clean_stream: DataFrame, lateness: str = DEFAULT_LATENESS) -> DataFrame:
    """Adds ``evt`` (wall clock read as UTC) with a watermark of ``lateness``.

    Spark drops a row once the event-time window it belongs to has closed
    (the previous micro-batch's watermark is past the window's end), so a
    late row still counts while its hour / day / 24 h window is open.  No reference rule exists; the allowed
    lateness is a parameter.
    """
    return clean_stream.withColumn("evt", event_time(F.col("ts"))).withWatermark("evt", lateness)


def _hour_string(day: Column, hour: Column) -> Column:
    return F.concat(date_string(day), F.lit(" "), F.lpad(hour.cast("string"), 2, "0"),
                    F.lit(":00:00"))


def alerts_stream(clean_stream: DataFrame, baseline: DataFrame, series: Sequence[str] = (),
                  holidays="us_federal", lateness: str = DEFAULT_LATENESS,
                  high: float = HIGH_RATIO, low: float = LOW_RATIO,
                  mode: str = "update", combine: str = "sum") -> StreamPlan:
    """L1 on the hour: each hourly record with its baseline and alert class.

    In update mode an open hour is classified by what has arrived of it so
    far and may change class; ``mode="append"`` classifies closed hours only.

    The hour total is a windowed aggregate (1 h tumbling); each micro-batch's
    emitted hours -- updated ones, or closed ones in append mode -- are joined
    with the static baseline and classified by the batch rule (L3).  Keyed by
    (series, date_time).
    """
    s = with_event_time(clean_stream, lateness)
    hours = (s.groupBy(F.window("evt", "1 hour"), *series,
                       F.to_date("ts").alias("day"), F.hour("ts").alias("hour"))
              .agg(_combined(combine)("traffic").alias("traffic")))
    frame = _flagged(hours, holidays).select(*series, _hour_string(F.col("day"), F.col("hour")).alias("date_time"),
                         date_string(F.col("day")).alias("date"), "hour", "is_holiday", "traffic")
    return StreamPlan(frame, [*series, "date_time"], _mode(mode),
                      lambda b: alerts_batch(b, baseline, series, high, low), closes=hour_end)


def alerts_stream_asof(clean_stream: DataFrame, versions: Callable[[], DataFrame], series: Sequence[str] = (),
                       holidays="us_federal", lateness: str = DEFAULT_LATENESS, high: float = HIGH_RATIO,
                       low: float = LOW_RATIO, mode: str = "update", combine: str = "sum") -> StreamPlan:
    """L1 on the hour with a baseline that is renewed while the stream runs.

    ``versions`` gives the published baseline versions and is called for every
    micro-batch; an hour is compared with the version of its own time
    (:mod:`flowtally.operators.asof`).  A version published with a
    ``valid_from`` after the hours that are still open changes no alert that
    was given.
    """
    plan = alerts_stream(clean_stream, None, series, holidays, lateness, high, low, mode, combine)
    plan.per_batch = lambda b: alerts_asof(b, versions(), series, high, low)
    return plan


def alerts_stream_records(hourly_stream: DataFrame, baseline: DataFrame,
                          series: Sequence[str] = (), high: float = HIGH_RATIO,
                          low: float = LOW_RATIO) -> StreamPlan:
    """L1, stateless form: the stream already carries clean hourly records
    (date_time, hour, is_holiday, traffic), so each record is enriched and
    classified on arrival (append mode; stream-static join)."""
    return StreamPlan(alerts_batch(hourly_stream, baseline, series, high, low),
                      [*series, "date_time"], "append", stateful=False)


def _day_slots(clean_stream: DataFrame, series: Sequence[str], lateness: str,
               combine: str) -> DataFrame:
    """One state row per (series, day): 24 hour sums, NULL = hour not seen.

    The 24 conditional sums aggregate map-side, do not depend on arrival
    order, and keep a whole day's curve in one small state row.
    """
    s = with_event_time(clean_stream, lateness)
    hour = F.hour("ts")
    slots = [_combined(combine)(F.when(hour == h, F.col("traffic"))) for h in range(HOURS_PER_DAY)]
    return (s.groupBy(F.window("evt", "1 day"), *series, F.to_date("ts").alias("day"))
             .agg(F.array(*slots).alias("slots")))


def _per_hour(slots: Column) -> Column:
    """Array of (hour, traffic, cumulative, seen_so_far) for the 24 hours."""
    zero = F.lit(0).cast("long")

    def entry(h: Column) -> Column:
        upto = F.slice(slots, 1, h + 1)
        return F.struct(
            h.alias("hour"),
            F.element_at(slots, h + 1).alias("traffic"),
            F.aggregate(upto, zero, lambda acc, y: acc + F.coalesce(y, zero)).alias("cum"),
            F.size(F.filter(upto, lambda y: y.isNotNull())).alias("seen"))

    return F.transform(F.sequence(F.lit(0), F.lit(HOURS_PER_DAY - 1)), entry)


def cumulative_stream(clean_stream: DataFrame, series: Sequence[str] = (),
                      holidays="us_federal", lateness: str = DEFAULT_LATENESS,
                      mode: str = "update", combine: str = "sum") -> StreamPlan:
    """The cumulative daily curve, one row per (series, date, hour seen)."""
    return _curve_plan(_flagged(_day_slots(clean_stream, series, lateness, combine), holidays), series, _mode(mode))


def cumulative_stream_marked(clean_stream: DataFrame, series: Sequence[str] = (),
                             lateness: str = DEFAULT_LATENESS, combine: str = "sum") -> StreamPlan:
    """W2 of records that carry a holiday marker of their own (``holiday_flag``
    on any row of a day, of whatever series), without a look at the data before.

    A second aggregate of the same stream holds each day's marker.  A day's
    curve waits in the join of the two until the watermark has closed the day,
    so the marker may come last.  Append mode.
    """
    slots = _day_slots(clean_stream, series, lateness, combine)
    marks = (with_event_time(clean_stream, lateness).groupBy(F.window("evt", "1 day").alias("_day"))
             .agg(F.coalesce(F.max("holiday_flag"), F.lit(0)).cast("int").alias("is_holiday")))
    return _curve_plan(slots.join(marks, slots["window"] == marks["_day"]), series, "append")


def _curve_plan(days: DataFrame, series: Sequence[str], mode: str) -> StreamPlan:
    frame = (days.select(*series, "day", "is_holiday", F.inline(_per_hour(F.col("slots"))))
             .where(F.col("traffic").isNotNull())
             .select(*series, date_string(F.col("day")).alias("date"),
                     F.col("hour").cast("int").alias("hour"),
                     F.col("cum").alias("cumulative_traffic"), "is_holiday"))
    return StreamPlan(frame, [*series, "date", "hour"], mode, closes=_day_end)


def running_day_mean_stream(clean_stream: DataFrame, series: Sequence[str] = (),
                            lateness: str = DEFAULT_LATENESS, mode: str = "update",
                            combine: str = "sum") -> StreamPlan:
    """Tumbling-day window fired every hour: mean of the day's hourly
    records so far."""
    days = _day_slots(clean_stream, series, lateness, combine)
    frame = (days.select(*series, "day", F.inline(_per_hour(F.col("slots"))))
             .where(F.col("traffic").isNotNull())
             .select(*series,
                     _hour_string(F.col("day"), F.col("hour")).alias("current_time"),
                     F.concat(date_string(F.col("day")), F.lit(" 00:00:00")).alias("window_start"),
                     mean_of(F.col("cum"), F.col("seen")).alias("avg_traffic"),
                     F.col("seen").cast("int").alias("data_count")))
    return StreamPlan(frame, [*series, "current_time"], _mode(mode), closes=_day_end)


def rolling_stream(clean_stream: DataFrame, series: Sequence[str] = (),
                   hours: int = ROLLING_HOURS, lateness: str = DEFAULT_LATENESS,
                   mode: str = "update", combine: str = "sum") -> StreamPlan:
    """Trailing ``hours``-hour mean of the hourly records, per hour.

    Same day-halo plan as the batch twin: event-time windows of ``1 + back``
    days sliding by one day (``back = ceil((hours-1)/24)``), so each event is
    copied ``1 + back`` times (2 for 24 h) -- not ``hours`` times as with a
    1-hour-slide window.  A window's state row holds one sum per hour slot
    (NULL = no record); it serves the outputs of its last day: for hour h the
    slots of ``(t - hours, t]``, emitted only when hour t holds a record, so
    each output row stands for one hourly record, like the batch twin.
    """
    if hours < 1:
        raise ValueError("hours must be positive")
    back = -(-(hours - 1) // HOURS_PER_DAY)
    n_slots = (back + 1) * HOURS_PER_DAY
    s = with_event_time(clean_stream, lateness)
    start_idx = instant_hour_index(F.col("window.start"))
    slot = hour_index(F.col("ts")) - start_idx
    slots = [_combined(combine)(F.when(slot == k, F.col("traffic"))) for k in range(n_slots)]
    wins = (s.groupBy(F.window("evt", f"{back + 1} days", "1 day"), *series)
             .agg(F.array(*slots).alias("slots")))
    zero = F.lit(0).cast("long")

    def entry(h: Column) -> Column:
        own = h + back * HOURS_PER_DAY  # 0-based slot of hour t
        covered = F.slice(F.col("slots"), own - (hours - 1) + 1, hours)
        return F.struct(
            (own).alias("own"),
            F.element_at(F.col("slots"), own + 1).alias("traffic"),
            F.aggregate(covered, zero, lambda acc, y: acc + F.coalesce(y, zero)).alias("_s"),
            F.size(F.filter(covered, lambda y: y.isNotNull())).alias("_n"))

    per_hour = F.transform(F.sequence(F.lit(0), F.lit(HOURS_PER_DAY - 1)), entry)
    t = F.col("_start") + F.col("own")
    frame = (wins.select(*series, start_idx.alias("_start"), F.inline(per_hour))
             .where(F.col("traffic").isNotNull())
             .select(*series,
                     hour_index_to_string(t).alias("current_time"),
                     hour_index_to_string(t - (hours - 1)).alias("window_start"),
                     mean_of(F.col("_s"), F.col("_n")).alias("avg_traffic"),
                     F.col("_n").cast("int").alias("data_count")))
    return StreamPlan(frame, [*series, "current_time"], _mode(mode), closes=_day_end)
