"""Registered queries: one per operator of the inventory, over whole tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame.  Stream queries
replay ``events.parquet`` as a file stream (``availableNow``) into a table
below the shared checkpoint folder and return that table, one row per key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtally.functions.holidays import us_federal_holiday
from flowtally.operators import (alerts, clean, cumulative_curve, daily_average, daily_total,
                                 hourly, hourly_baseline, rolling_mean, rolling_records, running_day_mean)
from flowtally.operators.asof import alerts_asof, baseline_table, baseline_version
from flowtally.operators.observe import METRICS, batch_metrics, observed
from flowtally.operators.prepare import marked_days, records, rejected
from flowtally.plans import (alert_distribution, check_convergence, check_endpoint, check_high,
                             check_low, check_normal, holiday_diff, import_counts)
from flowtally.plans.checks import endpoint_coverage, import_check, preview
from flowtally.plans.views import register_result_views
from flowtally.session import scratch_path
from flowtally.sinks import export_csv, save_result_table, write_csv_parts, write_table
from flowtally.sources import read_raw_csv, read_result_parts, read_result_table
from flowtally.sources.testdata import (EVENTS_SCHEMA, SERIES, event_hourly, event_stream, events_clean,
                                        lineitem_records, order_records, table)
from flowtally.schemas import CLEAN_SCHEMA, conform
from flowtally.sinks.keyed import KeyedTable
from flowtally.sources.stream import FileInput, file_stream
from flowtally.plans.incremental import arrive, hour_state, results
from flowtally.streaming import (LateRows, alerts_stream, alerts_stream_asof, alerts_stream_records, cumulative_stream,
                                 cumulative_stream_marked, end_marker, endpoint_stream, read_late, replay_in_order, replay_lateness, replay_records, rolling_stream,
                                 run_to_table, running_day_mean_stream, with_end_marker)
from flowtally.streaming.runner import output_schema

Query = Callable[[SparkSession, str], DataFrame]
SERIES_FIELD = T.StructType([T.StructField("series", T.StringType())])


# --- batch results -----------------------------------------------------------

def hourly_records(spark, sf_dir):
    """The clean hourly table."""
    return event_hourly(spark, sf_dir).select(
        "series", "date_time", "date", "hour", "is_holiday", "traffic", "n_records")


def q_hourly_baseline(spark, sf_dir):
    return hourly_baseline(event_hourly(spark, sf_dir), SERIES)


def q_hourly_baseline_rounded(spark, sf_dir):
    return hourly_baseline(event_hourly(spark, sf_dir), SERIES, rounding="half_up")


def q_daily_average(spark, sf_dir):
    return daily_average(event_hourly(spark, sf_dir), SERIES)


def q_daily_total(spark, sf_dir):
    """Straight from the clean records: a sum needs no hourly step, so there
    is one shuffle."""
    return daily_total(records(events_clean(table(spark, sf_dir, "events")), SERIES), SERIES)


def q_daily_total_dates(spark, sf_dir, dates=("2024-01-02", "2024-01-15")):
    """chosen days; the ranges reach the scan."""
    events = clean(table(spark, sf_dir, "events"), "ts", F.round(F.col("value") * 100),
                   {"series": "event_type"}, dates=dates)
    return daily_total(records(events, SERIES), SERIES)


def q_daily_total_orders(spark, sf_dir):
    return daily_total(order_records(spark, sf_dir), SERIES)


def q_daily_average_orders(spark, sf_dir):
    return daily_average(order_records(spark, sf_dir), SERIES)


def q_daily_total_lineitem(spark, sf_dir):
    return daily_total(lineitem_records(spark, sf_dir), SERIES)


def q_daily_average_lineitem(spark, sf_dir):
    return daily_average(lineitem_records(spark, sf_dir), SERIES)


def q_alerts_batch(spark, sf_dir):
    h = event_hourly(spark, sf_dir)
    return alerts(h, hourly_baseline(h, SERIES), SERIES)


def q_cumulative_batch(spark, sf_dir):
    return cumulative_curve(event_hourly(spark, sf_dir), SERIES)


def q_rolling24_batch(spark, sf_dir):
    return rolling_mean(event_hourly(spark, sf_dir), SERIES)


def q_running_day_mean_batch(spark, sf_dir):
    return running_day_mean(event_hourly(spark, sf_dir), SERIES)


def q_holiday_diff(spark, sf_dir):
    return holiday_diff(hourly_baseline(event_hourly(spark, sf_dir), SERIES), SERIES)


# --- stream results ----------------------------------------------------------

def _stored_hours(spark, sf_dir):
    """The hourly records written once: everything else reads these instead
    of the raw table."""
    return write_table(event_hourly(spark, sf_dir), scratch_path(spark, "hours"))


def _stored_baseline(spark, hours):
    """The baseline written once below the shared folder: the stream looks it
    up every micro-batch without recomputing it."""
    return write_table(hourly_baseline(hours, SERIES), scratch_path(spark, "baseline"))


def _replayed(spark, sf_dir):
    """The events as a clean stream, and the lateness that loses none."""
    lateness = replay_lateness(events_clean(table(spark, sf_dir, "events")))
    return events_clean(event_stream(spark, sf_dir)), lateness


def _stream_alerts(spark, sf_dir):
    base = _stored_baseline(spark, _stored_hours(spark, sf_dir))
    events, lateness = _replayed(spark, sf_dir)
    plan = alerts_stream(events, base, SERIES, lateness=lateness)
    return run_to_table(spark, plan, "alerts_stream"), base


def q_alerts_stream(spark, sf_dir):
    return _stream_alerts(spark, sf_dir)[0]


def _unordered(spark, sf_dir, files=4):
    """The events dealt over several files without order, one per trigger."""
    path = scratch_path(spark, "unordered")
    table(spark, sf_dir, "events").repartition(files, "event_id").write.parquet(path)
    return events_clean(file_stream(spark, path, EVENTS_SCHEMA, max_files_per_trigger=1))


def _appended(spark, sf_dir, name, make):
    """A stream job in append mode over unordered files, run to its end."""
    batch = events_clean(table(spark, sf_dir, "events"))
    lateness, folder = replay_lateness(batch), scratch_path(spark, "end_marker")
    plan = make(with_end_marker(_unordered(spark, sf_dir), folder), lateness)
    return run_to_table(spark, plan, name, finish=lambda: end_marker(batch, folder, lateness))


def q_cumulative_stream_append(spark, sf_dir):
    return _appended(spark, sf_dir, "cumulative_append", lambda events, late: cumulative_stream(
        events, SERIES, lateness=late, mode="append"))


def q_alerts_stream_append(spark, sf_dir):
    """L1 on closed hours only: no class is revised later."""
    base = _stored_baseline(spark, _stored_hours(spark, sf_dir))
    return _appended(spark, sf_dir, "alerts_append", lambda events, late: alerts_stream(
        events, base, SERIES, lateness=late, mode="append"))


def q_rolling24_stream_unordered(spark, sf_dir):
    lateness = replay_lateness(events_clean(table(spark, sf_dir, "events")))
    plan = rolling_stream(_unordered(spark, sf_dir), SERIES, lateness=lateness)
    return run_to_table(spark, plan, "rolling24_unordered")


def _files_in_turn(spark, sf_dir, files=4):
    """The events as files that came one after the other, each over the whole
    time: file k holds the ids with remainder k."""
    path = scratch_path(spark, "in_turn")
    for k in range(files):
        table(spark, sf_dir, "events").where(F.col("event_id") % files == k).coalesce(1) \
            .write.mode("append").parquet(path)
    return FileInput(path, EVENTS_SCHEMA)


def _late_replay(spark, sf_dir, lateness="5 days"):
    """The curve of what a short lateness keeps, and the rows it does not."""
    source, root = _files_in_turn(spark, sf_dir), scratch_path(spark, "late")
    late = LateRows(source, "ts", F.col("ts").isNotNull() & F.col("value").isNotNull())
    plan = cumulative_stream(events_clean(source.stream(spark, 1)), SERIES, lateness=lateness)
    curve = run_to_table(spark, plan, "late", root, late="store", late_rows=late)
    return curve, read_late(spark, f"{root}/late", late)


def q_late_rows(spark, sf_dir):
    """The rows that came too late, whole, with the end of their window."""
    return _late_replay(spark, sf_dir)[1].select(
        "event_id", F.col("event_type").alias("series"), "value", "batch_id",
        F.date_format("closed_at", "yyyy-MM-dd HH:mm:ss").alias("closed_at"),
        F.date_format("watermark", "yyyy-MM-dd HH:mm:ss").alias("watermark"))


def q_late_curve(spark, sf_dir):
    """W2 over the rows that came in time."""
    return _late_replay(spark, sf_dir)[0]


def q_replay_in_order(spark, sf_dir, files=24):
    """The line items, clustered by date over files, replayed in time
    order with the lateness that the files' overlap asks for."""
    path = scratch_path(spark, "clustered")
    table(spark, sf_dir, "lineitem").repartitionByRange(files, "l_shipdate").write.parquet(path)
    source = FileInput(path, spark.read.parquet(path).schema)

    def curve(raw, lateness):
        rows = clean(raw, "l_shipdate", F.round(F.col("l_extendedprice") * 100), {"series": "l_returnflag"})
        return cumulative_stream(rows, SERIES, lateness=lateness)

    return replay_in_order(spark, source, "l_shipdate", curve, "replay_in_order", files_per_wave=6)


def q_cumulative_stream_keyed(spark, sf_dir):
    """K3: micro-batches merged by key into a table of few files a month."""
    events, lateness = _unordered(spark, sf_dir, files=8), replay_lateness(events_clean(table(spark, sf_dir, "events")))
    plan = cumulative_stream(events, SERIES, lateness=lateness)
    kept = KeyedTable(spark, scratch_path(spark, "keyed"), output_schema(spark, plan), plan.keys,
                      "substring(date, 1, 7)", deltas=3)
    return run_to_table(spark, plan, "cumulative_keyed", table=kept)


def _arrivals(spark, sf_dir, files=3):
    """Hour sums after the events came file by file, with a repeated arrival."""
    source = scratch_path(spark, "arrivals")
    state = hour_state(spark, scratch_path(spark, "hour_state"), SERIES_FIELD, deltas=2)

    def read(paths):
        return events_clean(spark.read.schema(EVENTS_SCHEMA).parquet(*paths))

    for k in range(files):
        table(spark, sf_dir, "events").where(F.col("event_id") % files == k).coalesce(1) \
            .write.mode("append").parquet(source)
        arrive(state, source, read, SERIES)
    arrive(state, source, read, SERIES)
    return state


def q_incremental_baseline(spark, sf_dir):
    """A1 from the stored hour sums."""
    return results(_arrivals(spark, sf_dir), SERIES)["batch_hourly_baseline"]


def q_incremental_average(spark, sf_dir):
    """A2 from the stored hour sums."""
    return results(_arrivals(spark, sf_dir), SERIES)["batch_daily_average"]


def q_incremental_total(spark, sf_dir):
    """A3 from the stored hour sums."""
    return results(_arrivals(spark, sf_dir), SERIES)["batch_daily_total"]


RENEWED = ("2024-01-08 00:00:00", "2024-01-15 00:00:00", "2024-01-22 00:00:00")


def _published(spark, hours, times=RENEWED):
    """Baseline versions of the hours before each of ``times``."""
    versions = baseline_table(spark, scratch_path(spark, "versions"), SERIES_FIELD)
    for at in times:
        versions.add(baseline_version(hours, at, SERIES))
    return versions


def q_alerts_asof(spark, sf_dir):
    """J5/L3 against a baseline that is renewed every week."""
    hours = _stored_hours(spark, sf_dir)
    return alerts_asof(hours, _published(spark, hours).read(), SERIES)


def q_alerts_asof_stream(spark, sf_dir):
    """The same alerts by a replay over unordered files."""
    versions = _published(spark, _stored_hours(spark, sf_dir))
    lateness = replay_lateness(events_clean(table(spark, sf_dir, "events")))
    plan = alerts_stream_asof(_unordered(spark, sf_dir), versions.read, SERIES, lateness=lateness)
    return run_to_table(spark, plan, "alerts_asof")


def q_endpoint_live(spark, sf_dir):
    """V6 on two streams, either of which lost some days: the records lack
    the days of the month with remainder 3 by 7, the curve those with 2 by 5."""
    clean_events = events_clean(table(spark, sf_dir, "events"))
    lateness, day = replay_lateness(clean_events), F.dayofmonth("ts")
    root = scratch_path(spark, "live")
    rec = write_table(clean_events.where(day % 7 != 3), f"{root}/records")
    hours = cumulative_curve(event_hourly(spark, sf_dir), SERIES)
    at = F.to_timestamp_ntz(F.concat("date", F.lit(" "), F.lpad(F.col("hour").cast("string"), 2, "0"), F.lit(":00:00")))
    curve = write_table(hours.select("series", at.alias("ts"), "cumulative_traffic").where(day % 5 != 2), f"{root}/curve")
    sides = {"records": rec, "curve": curve}
    streams = {k: with_end_marker(FileInput(f"{root}/{k}", df.schema).stream(spark), f"{root}/end_{k}")
               for k, df in sides.items()}

    def finish():
        for k, df in sides.items():
            end_marker(df, f"{root}/end_{k}", lateness)

    plan = endpoint_stream(streams["records"], streams["curve"], SERIES, lateness)
    # Which side lacks the day is told by ``sides``; its numbers are 0 here.
    return run_to_table(spark, plan, "endpoint_live", finish=finish).fillna(0)


def q_intake_metrics(spark, sf_dir):
    """What the intake of the raw file read, rejected and kept, counted
    in the pass that writes the hours and in the stream's own batches."""
    path, root = _dirty_csv(spark, sf_dir), scratch_path(spark, "metrics")
    raw = spark.read.schema(DIRTY_CSV_SCHEMA).option("header", True).csv(path)
    seen = Observation("intake")
    write_table(hourly(_dirty_clean(observed(raw, "date_time", "traffic_volume", seen)), SERIES, combine="max"),
                f"{root}/hours")
    files = file_stream(spark, path, DIRTY_CSV_SCHEMA, fmt="csv", max_files_per_trigger=1)
    stream = _dirty_clean(observed(files, "date_time", "traffic_volume")).drop("holiday_flag")
    plan = cumulative_stream(stream, SERIES, lateness="100 days", combine="max")
    run_to_table(spark, plan, "metrics", f"{root}/stream", metrics=f"{root}/counts")
    both = batch_metrics(spark, seen, "batch").unionByName(
        spark.read.schema(METRICS).parquet(f"{root}/counts").withColumn("run", F.lit("stream")))
    return both.where(F.col("name") == "intake").groupBy("run", "metric").agg(F.sum("value").alias("value"))


CLEAN_STREAM_SCHEMA = T.StructType([T.StructField("series", T.StringType())]
                                   + list(CLEAN_SCHEMA.fields))


def q_alerts_stream_clean(spark, sf_dir):
    """L1 in its stateless form over S2: the hourly records are written as the
    cleaned table (headered CSV parts), and that folder is streamed record by
    record through the baseline join and the classification (append mode)."""
    h = _stored_hours(spark, sf_dir)
    path = scratch_path(spark, "clean_table")
    write_csv_parts(h.select(*CLEAN_STREAM_SCHEMA.names), path)
    base = _stored_baseline(spark, h)
    stream = file_stream(spark, path, CLEAN_STREAM_SCHEMA, fmt="csv")
    return run_to_table(spark, alerts_stream_records(stream, base, SERIES), "alerts_stream_clean")


def q_cumulative_stream(spark, sf_dir):
    events, lateness = _replayed(spark, sf_dir)
    plan = cumulative_stream(events, SERIES, lateness=lateness)
    return run_to_table(spark, plan, "cumulative_stream")


def q_rolling24_stream(spark, sf_dir):
    events, lateness = _replayed(spark, sf_dir)
    plan = rolling_stream(events, SERIES, lateness=lateness)
    return run_to_table(spark, plan, "rolling24_stream")


def q_running_day_mean_stream(spark, sf_dir):
    events, lateness = _replayed(spark, sf_dir)
    plan = running_day_mean_stream(events, SERIES, lateness=lateness)
    return run_to_table(spark, plan, "running_day_mean_stream")


# --- checks (stream side vs batch side) --------------------------------------

def q_alert_distribution(spark, sf_dir):
    return alert_distribution(q_alerts_stream(spark, sf_dir))


def q_check_high(spark, sf_dir):
    a, base = _stream_alerts(spark, sf_dir)
    return check_high(a, base, SERIES)


def q_check_low(spark, sf_dir):
    a, base = _stream_alerts(spark, sf_dir)
    return check_low(a, base, SERIES)


def q_check_normal(spark, sf_dir):
    a, base = _stream_alerts(spark, sf_dir)
    return check_normal(a, base, SERIES)


def q_check_endpoint(spark, sf_dir):
    return check_endpoint(q_daily_total(spark, sf_dir), q_cumulative_stream(spark, sf_dir), SERIES)


def q_check_endpoint_last(spark, sf_dir):
    return check_endpoint(q_daily_total(spark, sf_dir), q_cumulative_stream(spark, sf_dir),
                          SERIES, endpoint_hour=None)


def q_check_convergence(spark, sf_dir):
    return check_convergence(q_rolling24_stream(spark, sf_dir), q_daily_average(spark, sf_dir),
                             SERIES)


def _imported(spark, sf_dir):
    """The batch tables, and as read back (S3) from CSV parts (K1)."""
    h = _stored_hours(spark, sf_dir)
    root = scratch_path(spark, "batch_output")
    tables = {
        "batch_hourly_baseline": hourly_baseline(h, SERIES),
        "batch_daily_average": daily_average(h, SERIES),
        "batch_daily_total": daily_total(h, SERIES),
    }
    read_back = {}
    for name, df in tables.items():
        write_csv_parts(df, f"{root}/{name}")
        read_back[name] = read_result_parts(spark, f"{root}/{name}", name, SERIES_FIELD)
    return tables, read_back


def q_import_counts(spark, sf_dir):
    """V8: the imported tables counted."""
    return import_counts(_imported(spark, sf_dir)[1])


def q_import_check(spark, sf_dir):
    """V8 as a check: rows before the import next to rows after it, and the
    rows that differ in any value."""
    return import_check(*_imported(spark, sf_dir))


def q_export_round_trip(spark, sf_dir):
    """K4: the daily totals as one CSV file, read back."""
    path = scratch_path(spark, "export")
    export_csv(q_daily_total(spark, sf_dir), path)
    return read_result_parts(spark, path, "batch_daily_total", SERIES_FIELD)


def q_conformed_total(spark, sf_dir):
    """K5: the daily totals in their declared columns and types."""
    return conform(q_daily_total(spark, sf_dir), "batch_daily_total", SERIES)


def q_view_select(spark, sf_dir):
    """SELECT * on a result table registered under its name."""
    root = scratch_path(spark, "views")
    write_csv_parts(q_conformed_total(spark, sf_dir), f"{root}/batch_daily_total")
    register_result_views(spark, batch_dir=root, series=SERIES)
    return spark.sql("SELECT * FROM batch_daily_total")


def q_catalog_round_trip(spark, sf_dir):
    """K2 and S4 on the session's catalog."""
    path = scratch_path(spark, "catalog")
    name = "baseline_" + path.rsplit("-", 1)[1]
    save_result_table(q_hourly_baseline(spark, sf_dir), name, "batch_hourly_baseline", path, SERIES)
    return read_result_table(spark, name, "batch_hourly_baseline", SERIES)


def q_total_preview(spark, sf_dir, n: int = 10):
    """The first rows of a table in a stated order."""
    return preview(q_daily_total(spark, sf_dir), n, ["series", "date"])


def q_endpoint_coverage(spark, sf_dir):
    """V6's other half: days that only one side has."""
    return endpoint_coverage(q_daily_total(spark, sf_dir), q_cumulative_stream(spark, sf_dir), SERIES)


def q_endpoint_coverage_lossy(spark, sf_dir):
    """V6's other half where both sides lost days: the totals those of the
    month with remainder 3 by 7, the curve those with 2 by 5."""
    day = F.dayofmonth(F.to_date("date"))
    curve = cumulative_curve(event_hourly(spark, sf_dir), SERIES)
    return endpoint_coverage(q_daily_total(spark, sf_dir).where(day % 7 != 3), curve.where(day % 5 != 2), SERIES)


def q_import_check_damaged(spark, sf_dir):
    """V8 on an import that lost the baseline's rows of hour 5 and changed the
    totals of the ninth day of each month."""
    before, after = _imported(spark, sf_dir)
    ninth = F.dayofmonth(F.to_date("date")) == 9
    after["batch_hourly_baseline"] = after["batch_hourly_baseline"].where("hour <> 5")
    after["batch_daily_total"] = after["batch_daily_total"].withColumn(
        "total_daily_traffic", F.col("total_daily_traffic") + F.when(ninth, 1).otherwise(0))
    return import_check(before, after)


RAW_CSV_SCHEMA = T.StructType([
    T.StructField("series", T.StringType()), T.StructField("holiday", T.StringType()),
    T.StructField("date_time", T.StringType()), T.StructField("traffic_volume", T.LongType())])


def q_csv_round_trip(spark, sf_dir):
    """S1 + P1-P3 on raw CSV: events written as a raw traffic file whose
    holiday column marks only the midnight rows of a holiday, read back with
    a declared schema and cleaned; the day-level flag is spread from the
    marked rows."""
    ev = table(spark, sf_dir, "events")
    marked = (F.hour("ts") == 0) & (us_federal_holiday(F.to_date("ts")) == 1)
    raw = ev.select(F.col("event_type").alias("series"),
                    F.when(marked, "Holiday").otherwise("None").alias("holiday"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date_time"),
                    F.round(F.col("value") * 100).cast("long").alias("traffic_volume"))
    path = scratch_path(spark, "raw_csv")
    write_csv_parts(raw, path)
    good, _bad = read_raw_csv(spark, path, RAW_CSV_SCHEMA)
    c = clean(good, "date_time", "traffic_volume", ["series"],
              flag=(F.col("holiday") != "None").cast("int"))
    return hourly(c, SERIES).select("series", "date_time", "date", "hour", "is_holiday",
                                    "traffic", "n_records")


DIRTY_CSV_SCHEMA = T.StructType([
    T.StructField("series", T.StringType()), T.StructField("holiday", T.StringType()),
    T.StructField("date_time", T.StringType()), T.StructField("traffic_volume", T.StringType())])


def _dirty_csv(spark, sf_dir):
    """Events as a raw traffic file with unreadable values, repeated rows and
    holidays marked at midnight only; the folder."""
    ev = table(spark, sf_dir, "events").where("ts IS NOT NULL AND value IS NOT NULL")
    twice = ev.unionByName(ev.where("event_id % 89 = 0"))
    marked = (F.hour("ts") == 0) & (us_federal_holiday(F.to_date("ts")) == 1)
    cell = F.when(F.col("event_id") % 97 == 0, "n/a").otherwise(
        F.round(F.col("value") * 100).cast("long").cast("string"))
    path = scratch_path(spark, "dirty_csv")
    write_csv_parts(twice.select(
        F.col("event_type").alias("series"), F.when(marked, "Holiday").otherwise("None").alias("holiday"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date_time"), cell.alias("traffic_volume")), path)
    return path


def _dirty_clean(raw):
    return clean(raw, "date_time", "traffic_volume", ["series"],
                 flag=(F.col("holiday") != "None").cast("int"))


def q_dirty_csv(spark, sf_dir):
    """P1-P3 on a raw file: unreadable values go, repeated readings of an hour
    count once (the largest), a marker flags its day."""
    good, _ = read_raw_csv(spark, _dirty_csv(spark, sf_dir), DIRTY_CSV_SCHEMA)
    return hourly(_dirty_clean(good), SERIES, combine="max").select(
        "series", "date_time", "date", "hour", "is_holiday", "traffic", "n_records")


def q_dirty_csv_rejected(spark, sf_dir):
    """The rows that cleaning drops, counted by reason."""
    good, _ = read_raw_csv(spark, _dirty_csv(spark, sf_dir), DIRTY_CSV_SCHEMA)
    return rejected(good, "date_time", "traffic_volume").groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("record_count"))


def q_dirty_csv_stream(spark, sf_dir):
    """The same rules on the stream side: the curve over the raw file."""
    path = _dirty_csv(spark, sf_dir)
    batch = _dirty_clean(read_raw_csv(spark, path, DIRTY_CSV_SCHEMA)[0])
    days = write_table(marked_days(batch), scratch_path(spark, "marked_days"))
    stream = _dirty_clean(file_stream(spark, path, DIRTY_CSV_SCHEMA, fmt="csv")).drop("holiday_flag")
    plan = cumulative_stream(stream, SERIES, holidays=days, lateness=replay_lateness(batch),
                             combine="max")
    return run_to_table(spark, plan, "dirty_csv_stream")


def q_dirty_csv_stream_marked(spark, sf_dir):
    """P3 in a stream: the raw file's own markers, no pass over it before."""
    path = _dirty_csv(spark, sf_dir)
    batch = _dirty_clean(read_raw_csv(spark, path, DIRTY_CSV_SCHEMA)[0])
    lateness, folder = replay_lateness(batch), scratch_path(spark, "end_marker")
    stream = with_end_marker(_dirty_clean(file_stream(spark, path, DIRTY_CSV_SCHEMA, fmt="csv")), folder)
    plan = cumulative_stream_marked(stream, SERIES, lateness, combine="max")
    return run_to_table(spark, plan, "dirty_marked", finish=lambda: end_marker(batch, folder, lateness))


def q_rolling_records(spark, sf_dir):
    """W4 at every record instead of every hour."""
    return rolling_records(events_clean(table(spark, sf_dir, "events")), SERIES)


def q_rolling_records_stream(spark, sf_dir):
    """W3 at every record, each once its hour is closed."""
    source = _files_in_turn(spark, sf_dir, 3)
    lateness = replay_lateness(events_clean(table(spark, sf_dir, "events")))
    return replay_records(spark, source, "ts", events_clean, SERIES, lateness=lateness, max_files_per_trigger=1)


# --- ordering and top-k ------------------------------------------------------

def q_rolling_topk(spark, sf_dir, k: int = 20):
    """O3: ``ORDER BY current_time LIMIT k`` (series breaks ties)."""
    return q_rolling24_stream(spark, sf_dir).orderBy("current_time", "series").limit(k)


def q_curve_ordered(spark, sf_dir):
    """O2: the curve sorted by (series, date, hour)."""
    return q_cumulative_stream(spark, sf_dir).orderBy("series", "date", "hour")


QUERIES: dict[str, Query] = {
    "hourly_records": hourly_records,
    "hourly_baseline": q_hourly_baseline,
    "hourly_baseline_rounded": q_hourly_baseline_rounded,
    "daily_average": q_daily_average,
    "daily_total": q_daily_total,
    "daily_total_dates": q_daily_total_dates,
    "daily_total_orders": q_daily_total_orders,
    "daily_average_orders": q_daily_average_orders,
    "daily_total_lineitem": q_daily_total_lineitem,
    "daily_average_lineitem": q_daily_average_lineitem,
    "holiday_diff": q_holiday_diff,
    "alerts_batch": q_alerts_batch,
    "alerts_stream": q_alerts_stream,
    "alerts_stream_clean": q_alerts_stream_clean,
    "alert_distribution": q_alert_distribution,
    "check_high": q_check_high,
    "check_low": q_check_low,
    "check_normal": q_check_normal,
    "cumulative_batch": q_cumulative_batch,
    "cumulative_stream": q_cumulative_stream,
    "rolling24_batch": q_rolling24_batch,
    "rolling24_stream": q_rolling24_stream,
    "running_day_mean_batch": q_running_day_mean_batch,
    "running_day_mean_stream": q_running_day_mean_stream,
    "check_endpoint": q_check_endpoint,
    "check_endpoint_last": q_check_endpoint_last,
    "check_convergence": q_check_convergence,
    "endpoint_coverage": q_endpoint_coverage,
    "import_counts": q_import_counts,
    "import_check": q_import_check,
    "endpoint_coverage_lossy": q_endpoint_coverage_lossy,
    "import_check_damaged": q_import_check_damaged,
    "export_round_trip": q_export_round_trip,
    "conformed_total": q_conformed_total,
    "view_select": q_view_select,
    "catalog_round_trip": q_catalog_round_trip,
    "total_preview": q_total_preview,
    "cumulative_stream_append": q_cumulative_stream_append,
    "alerts_stream_append": q_alerts_stream_append,
    "rolling24_stream_unordered": q_rolling24_stream_unordered,
    "dirty_csv": q_dirty_csv,
    "dirty_csv_rejected": q_dirty_csv_rejected,
    "dirty_csv_stream": q_dirty_csv_stream,
    "csv_round_trip": q_csv_round_trip,
    "late_rows": q_late_rows,
    "late_curve": q_late_curve,
    "replay_in_order": q_replay_in_order,
    "cumulative_stream_keyed": q_cumulative_stream_keyed,
    "incremental_baseline": q_incremental_baseline,
    "incremental_average": q_incremental_average,
    "incremental_total": q_incremental_total,
    "alerts_asof": q_alerts_asof,
    "alerts_asof_stream": q_alerts_asof_stream,
    "endpoint_live": q_endpoint_live,
    "intake_metrics": q_intake_metrics,
    "dirty_csv_stream_marked": q_dirty_csv_stream_marked,
    "rolling_records": q_rolling_records,
    "rolling_records_stream": q_rolling_records_stream,
    "rolling_topk": q_rolling_topk,
    "curve_ordered": q_curve_ordered,
}
