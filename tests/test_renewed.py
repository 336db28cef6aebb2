"""Renewed baselines, live endpoints, counts of an intake, markers in a
stream, and the trailing mean at every record."""

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtally.operators import alerts, clean, cumulative_curve, hourly, hourly_baseline, rolling_mean, rolling_records
from flowtally.operators.asof import alerts_asof, baseline_table, baseline_version, join_version
from flowtally.operators.observe import METRICS, batch_metrics, observed
from flowtally.sources.stream import FileInput
from flowtally.sources.testdata import EVENTS_SCHEMA, SERIES, event_hourly, events_clean, table
from flowtally.streaming import (alerts_stream_asof, cumulative_stream, cumulative_stream_marked, end_marker,
                                 endpoint_stream, run_to_table, with_end_marker)
from tests.conftest import SF_SMALL

FIELD = T.StructType([T.StructField("series", T.StringType())])
CLEAN = "series string, ts timestamp_ntz, traffic long"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- as-of baselines ---------------------------------------------------------

def test_version_of_the_records_own_time(spark):
    rec = spark.createDataFrame(
        [(s, f"2024-01-{d:02} 05:00:00", f"2024-01-{d:02}", 5, 0, 100) for d in range(1, 11) for s in ("a", None)],
        "series string, date_time string, date string, hour int, is_holiday int, traffic long")
    versions = spark.createDataFrame(
        [(s, 0, 5, v, at) for s in ("a", None) for v, at in (
            (100.0, "2024-01-03 00:00:00"), (10.0, "2024-01-05 05:00:00"), (400.0, "2024-01-08 05:00:01"))],
        "series string, is_holiday int, hour int, avg_traffic double, valid_from string")
    got = {(r.series, int(r.date_time[8:10])): (r.baseline, r.alert_status) for r in alerts_asof(
        rec, versions, SERIES).collect()}
    want = {d: (100.0, "NORMAL") if d < 5 else (10.0, "HIGH_ALERT") if d < 9 else (400.0, "LOW_ALERT")
            for d in range(3, 11)}
    assert got == {(s, d): v for d, v in want.items() for s in ("a", None)}
    twice = versions.unionByName(versions)
    with pytest.raises(Exception, match="from the same time"):
        join_version(rec, twice, SERIES).collect()
    assert alerts_asof(rec, versions.where("false"), SERIES).count() == 0


def test_one_version_is_the_plain_baseline(spark):
    hours = event_hourly(spark, SF_SMALL)
    base = hourly_baseline(hours, SERIES)
    got = alerts_asof(hours, base.withColumn("valid_from", F.lit("2000-01-01 00:00:00")), SERIES)
    want = alerts(hours, base, SERIES)
    assert rows(got.select(*want.columns)) == rows(want)


def test_baseline_renewed_while_the_stream_runs(spark, tmp_path):
    """Versions are published between two runs of one stream; the replay of
    all files at once gives the same alerts."""
    events, path = table(spark, SF_SMALL, "events"), f"{tmp_path}/in"
    hours = event_hourly(spark, SF_SMALL)
    versions = baseline_table(spark, f"{tmp_path}/versions", FIELD)
    versions.add(baseline_version(hours, "2024-01-04 00:00:00", SERIES))
    source = FileInput(path, EVENTS_SCHEMA)

    def run(root):
        plan = alerts_stream_asof(events_clean(source.stream(spark)), versions.read, SERIES, lateness="40 days")
        return run_to_table(spark, plan, "a", root)

    events.where("ts < '2024-01-10'").write.parquet(path)
    early = rows(run(f"{tmp_path}/run"))
    for at in ("2024-01-10 00:00:00", "2024-01-20 00:00:00"):
        versions.add(baseline_version(hours, at, SERIES))
    events.where("ts >= '2024-01-10'").write.mode("append").parquet(path)
    got = run(f"{tmp_path}/run")
    want = alerts_asof(hours, versions.read(), SERIES)
    assert rows(got.select(*want.columns)) == rows(want)
    assert set(early) <= set(rows(got)) and {r[-1] for r in rows(want)} == {
        "2024-01-04 00:00:00", "2024-01-10 00:00:00", "2024-01-20 00:00:00"}
    assert rows(run(f"{tmp_path}/again")) == rows(got)


# --- live endpoints ----------------------------------------------------------

def test_lost_days_come_out_once(spark, tmp_path):
    def at(day, hour):
        return dt.datetime(2024, 1, day, hour)

    records = [(s, at(d, h), 10 * h) for s in ("a", None) for d in (1, 2, 4, 5) for h in (1, 7)]
    curve = [(s, at(d, h), 10 if h == 1 else 80 + (d == 5)) for s in ("a", None) for d in (1, 3, 4, 5) for h in (1, 7)]
    frames = {"records": spark.createDataFrame(records, CLEAN),
              "curve": spark.createDataFrame(curve, CLEAN.replace("traffic", "cumulative_traffic"))}
    streams = {}
    for name, df in frames.items():
        df.repartition(3).write.parquet(f"{tmp_path}/{name}")
        streams[name] = with_end_marker(FileInput(f"{tmp_path}/{name}", df.schema).stream(spark, 1), f"{tmp_path}/end_{name}")

    def finish():
        for name, df in frames.items():
            end_marker(df, f"{tmp_path}/end_{name}", "20 days")

    plan = endpoint_stream(streams["records"], streams["curve"], SERIES, "20 days")
    got = run_to_table(spark, plan, "live", f"{tmp_path}/run", finish=finish)
    day = {1: (80, 80, 0, "both"), 2: (80, None, None, "total only"), 3: (None, 80, None, "curve only"),
           4: (80, 80, 0, "both"), 5: (80, 81, -1, "both")}
    assert rows(got) == sorted(((s, f"2024-01-0{d}", *v) for s in ("a", None) for d, v in day.items()), key=str)


# --- counts ------------------------------------------------------------------

def test_counts_equal_separate_counts(spark, tmp_path):
    raw = spark.createDataFrame(
        [("2024-01-01 00:00:00", "1", None), ("2024-01-01 01:00:00", "x", None), ("?", "1", None), (None, None, None),
         (None, None, "a,b,c,d"), ("2024-01-02 00:00:00", "7", None)], "at string, v string, bad string")
    seen = Observation("intake")
    kept = clean(observed(raw, "at", "v", seen, corrupt="bad").where("bad IS NULL"), "at", "v")
    kept.write.parquet(f"{tmp_path}/kept")
    want = {"rows_read": 6, "malformed": 1, "rejected_time": 2, "rejected_value": 1, "kept": 2}
    assert {r.metric: r.value for r in batch_metrics(spark, seen, "x").collect()} == want
    assert spark.read.parquet(f"{tmp_path}/kept").count() == want["kept"]


def test_counts_of_every_batch(spark, tmp_path):
    schema = "at string, v string"
    for i in range(3):
        spark.createDataFrame([(f"2024-01-0{i + 1} 00:00:00", "1"), ("?", "2")] * (i + 1), schema).coalesce(1) \
            .write.mode("append").parquet(f"{tmp_path}/in")
    source = FileInput(f"{tmp_path}/in", T._parse_datatype_string(schema))
    stream = clean(observed(source.stream(spark, 1), "at", "v"), "at", "v")
    run_to_table(spark, cumulative_stream(stream, (), lateness="9 days"), "m", f"{tmp_path}/run",
                 metrics=f"{tmp_path}/counts")
    got = spark.read.schema(METRICS).parquet(f"{tmp_path}/counts").where("name = 'intake'").collect()
    by_batch = {(r.batch_id, r.metric): r.value for r in got}
    assert [by_batch[i, "rows_read"] for i in range(3)] == [2, 4, 6]
    assert [by_batch[i, "rejected_time"] for i in range(3)] == [1, 2, 3]


# --- markers in a stream -----------------------------------------------------

def test_marker_that_comes_last(spark, tmp_path):
    schema = "k string, at string, v long, off int"
    parts = [[("a", "2024-03-01 05:00:00", 3, 0), ("b", "2024-03-01 06:00:00", 4, None)],
             [("a", "2024-03-02 05:00:00", 5, 0)], [("b", "2024-03-01 00:00:00", 2, 1), (None, "2024-03-02 07:00:00", 1, 0)]]
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    source = FileInput(f"{tmp_path}/in", T._parse_datatype_string(schema))

    def cleaned(df):
        return clean(df, "at", "v", {"series": "k"}, flag=F.col("off"))

    batch = cleaned(source.rows(spark))
    stream = with_end_marker(cleaned(source.stream(spark, 1)), f"{tmp_path}/end")
    got = run_to_table(spark, cumulative_stream_marked(stream, SERIES, "9 days"), "m", f"{tmp_path}/run",
                       finish=lambda: end_marker(batch, f"{tmp_path}/end", "9 days"))
    want = cumulative_curve(hourly(batch, SERIES), SERIES)
    assert rows(got.select(*want.columns)) == rows(want)
    assert {r.date: r.is_holiday for r in want.collect()} == {"2024-03-01": 1, "2024-03-02": 0}


# --- every record ------------------------------------------------------------

def brute_rolling(items, hours):
    out = []
    for s, t, v in items:
        lately = [x for k, at, x in items if k == s and t - dt.timedelta(hours=hours) < at <= t]
        out.append((s, t.strftime("%Y-%m-%d %H:%M:%S.%f"), v, sum(lately) / len(lately), len(lately)))
    return sorted(out, key=str)


@pytest.mark.parametrize("hours", [1, 5, 24, 30])
def test_trailing_mean_at_every_record(spark, hours):
    import random
    r = random.Random(hours)
    first = dt.datetime(2024, 1, 30, 22)
    items = [(r.choice(["a", "b", None]), first + dt.timedelta(minutes=r.randrange(0, 4500, 15)), r.randrange(100))
             for _ in range(250)]
    items += [("hot", first + dt.timedelta(seconds=i * 40), i) for i in range(300)]
    items += [("edge", first + dt.timedelta(hours=h * hours, microseconds=m), 1) for h in range(3) for m in (0, 1)]
    got = rolling_records(spark.createDataFrame(items, CLEAN), SERIES, hours)
    assert rows(got.drop("window_start")) == brute_rolling(items, hours)


def test_last_record_of_an_hour_is_the_hourly_value(spark):
    """With one record an hour both grains agree."""
    hours = event_hourly(spark, SF_SMALL)
    one = hours.select("series", F.to_timestamp_ntz("date_time").alias("ts"), "traffic")
    a = rolling_records(one, SERIES).select("series", F.substring("current_time", 1, 19), "avg_traffic", "data_count")
    b = rolling_mean(hours, SERIES).select("series", "current_time", "avg_traffic", "data_count")
    assert rows(a) == rows(b) and events_clean(table(spark, SF_SMALL, "events")).count() >= len(rows(a))


def in_turn(spark, path, parts):
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
    return FileInput(path, EVENTS_SCHEMA)


@pytest.mark.parametrize("lateness", ["0 seconds", "4 days", "40 days"])
def test_records_in_a_stream(spark, tmp_path, lateness):
    """Files over the whole time, one a micro-batch: the batch's means over
    the records that were in time; every record once."""
    from flowtally.streaming import LateRows, replay_records
    from flowtally.streaming.jobs import hour_end
    events = table(spark, SF_SMALL, "events")
    source = in_turn(spark, f"{tmp_path}/in x", [events.where(F.col("event_id") % 4 == k) for k in range(4)])
    stats = {}
    got = replay_records(spark, source, "ts", events_clean, SERIES, 24, lateness, root=f"{tmp_path}/run",
                         max_files_per_trigger=1, late="report", stats=stats)
    late = LateRows(source, "ts", "ts IS NOT NULL AND value IS NOT NULL")
    lost = [late.of_batch(spark, f"{tmp_path}/run/checkpoint", b, hour_end) for b in range(4)]
    kept = events
    for rows_of_batch in lost:
        if rows_of_batch is not None:
            kept = kept.join(rows_of_batch.select("event_id"), "event_id", "left_anti")
    want = rolling_records(events_clean(kept), SERIES)
    assert rows(got) == rows(want) and (stats["dropped_late_groups"] == 0) == (lateness == "40 days")
    assert (kept.count() == events.count()) == (lateness == "40 days")


def test_records_of_later_files_join_their_windows(spark, tmp_path):
    """Hours closed by one micro-batch are the window of the next ones."""
    from flowtally.streaming import replay_records
    events = table(spark, SF_SMALL, "events").orderBy("ts")
    cuts = ["2024-01-05", "2024-01-06", "2024-01-06 12:00:00", "2024-01-19"]
    parts, rest = [], events
    for cut in cuts:
        parts.append(rest.where(F.col("ts") < cut))
        rest = rest.where(F.col("ts") >= cut)
    source = in_turn(spark, f"{tmp_path}/in", [*parts, rest])
    got = replay_records(spark, source, "ts", events_clean, SERIES, 24, "0 seconds", root=f"{tmp_path}/run",
                         max_files_per_trigger=1)
    assert rows(got) == rows(rolling_records(events_clean(events), SERIES))
    assert len(spark.read.parquet(f"{tmp_path}/run/out").select("batch_id").distinct().collect()) >= 4
    empty = replay_records(spark, in_turn(spark, f"{tmp_path}/none", [events.where("false")]), "ts", events_clean,
                           SERIES, root=f"{tmp_path}/empty")
    assert empty.count() == 0
