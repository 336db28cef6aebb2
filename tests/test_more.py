"""Sinks and options: single-file export, chosen dates (F4), stateless
stream alerts, previews, endpoint at the last hour."""

import os

from pyspark.sql import functions as F

from flowtally.operators import alerts, clean, cumulative_curve, daily_average, daily_total, hourly, hourly_baseline
from flowtally.plans import check_convergence, check_endpoint, preview
from flowtally.plans.inspect import plan_text
from flowtally.sinks import export_csv, write_table
from flowtally.sources import file_stream
from flowtally.sources.testdata import SERIES, event_hourly
from flowtally.streaming import alerts_stream_records, run_to_table
from flowtally.operators import rolling_mean
from tests.conftest import SF_SMALL


def test_export_single_csv(spark, tmp_path):
    base = hourly_baseline(event_hourly(spark, SF_SMALL), SERIES)
    out = str(tmp_path / "base")
    export_csv(base, out)
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(files) == 1
    lines = open(os.path.join(out, files[0])).read().splitlines()
    assert lines[0] == "series,is_holiday,hour,avg_traffic" and len(lines) == base.count() + 1


def test_export_has_no_row_limit(spark, tmp_path):
    n = 1_050_000
    df = spark.range(n).select("id", (F.col("id") * 3).alias("v"))
    export_csv(df, str(tmp_path / "big"))
    assert len([f for f in os.listdir(tmp_path / "big") if f.endswith(".csv")]) == 1
    back = spark.read.schema("id long, v long").option("header", True).csv(str(tmp_path / "big"))
    assert back.agg(F.count("*"), F.sum("id"), F.sum("v")).first() == (n, n * (n - 1) // 2, 3 * n * (n - 1) // 2)


def test_chosen_dates(spark):
    h = event_hourly(spark, SF_SMALL)
    keep = ["2024-01-01", "2024-01-10"]
    got = {r.date for r in daily_total(h, SERIES, dates=keep).collect()}
    assert got == set(keep)
    got = {r.date for r in daily_average(h, SERIES, dates=keep).collect()}
    assert got == set(keep)
    ends = check_endpoint(daily_total(h, SERIES), cumulative_curve(h, SERIES), SERIES,
                          endpoint_hour=None, dates=["2024-01-15"]).collect()
    assert {r.date for r in ends} == {"2024-01-15"} and all(r.diff == 0 for r in ends)
    assert all(r.day_type == "节假日" for r in ends)
    conv = check_convergence(rolling_mean(h, SERIES), daily_average(h, SERIES), SERIES,
                             dates=["2024-01-02"]).collect()
    assert conv and all(r.current_time.startswith("2024-01-02") for r in conv)


def test_record_grain_date_filter_keeps_types(spark):
    from flowtally.sources.testdata import lineitem_records
    li = lineitem_records(spark, SF_SMALL)
    assert dict(li.dtypes)["date"] == "date"
    out = daily_total(li, SERIES, dates=["1996-01-02"])
    assert dict(out.dtypes)["date"] == "string"


def test_stateless_stream_alerts_on_clean_hourly_records(spark, tmp_path):
    h = event_hourly(spark, SF_SMALL)
    base = write_table(hourly_baseline(h, SERIES), str(tmp_path / "base"))
    src = str(tmp_path / "clean")
    h.repartition(3).write.parquet(src)
    stream = file_stream(spark, src, h.schema, max_files_per_trigger=1)
    got = run_to_table(spark, alerts_stream_records(stream, base, SERIES), "l1",
                       str(tmp_path / "run"))
    want = alerts(h, base, SERIES)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == \
        sorted(map(tuple, want.collect()))


def test_preview(spark):
    h = event_hourly(spark, SF_SMALL)
    assert preview(h).count() == 10
    top = preview(h, 3, ["date_time", "series"])
    assert "TakeOrderedAndProject" in plan_text(top)
    assert [r.date_time for r in top.collect()] == sorted(r.date_time for r in top.collect())


def test_time_range_keeps_only_that_range(spark):
    from flowtally.sources.testdata import table
    ev = table(spark, SF_SMALL, "events")
    h = hourly(clean(ev, "ts", F.round(F.col("value") * 100), {"series": "event_type"},
                     time_range=("2024-01-02", "2024-01-03")), SERIES)
    assert {r.date for r in h.select("date").distinct().collect()} == {"2024-01-02"}


def test_unmatched_records_metric(spark):
    from flowtally.operators import unmatched_records
    raw = spark.createDataFrame([("2024-03-05 01:00:00", 5), ("2024-03-05 02:00:00", 10),
                                 ("2024-03-06 02:00:00", 12)], "date_time string, traffic long")
    rec = hourly(clean(raw, "date_time", "traffic"))
    base = spark.createDataFrame([(0, 1, 4.0)], "is_holiday int, hour int, avg_traffic double")
    assert unmatched_records(rec, base).first().unmatched_records == 2
    assert alerts(rec, base).count() == 1


def test_clean_table_round_trip(spark, tmp_path):
    from flowtally.schemas import CLEAN_SCHEMA
    from flowtally.sources import read_clean
    h = event_hourly(spark, SF_SMALL).select(*CLEAN_SCHEMA.names)
    h.write.parquet(str(tmp_path / "pq"))
    h.write.option("header", True).csv(str(tmp_path / "csv"))
    want = sorted(map(tuple, h.collect()))
    assert sorted(map(tuple, read_clean(spark, str(tmp_path / "pq")).collect())) == want
    assert sorted(map(tuple, read_clean(spark, str(tmp_path / "csv"), "csv").collect())) == want


def test_calendar_table_flags_whole_days(spark):
    raw = spark.createDataFrame([("2024-03-05 01:00:00", 5), ("2024-03-06 02:00:00", 7),
                                 ("2024-03-06 05:00:00", 9)], "date_time string, traffic long")
    cal = spark.createDataFrame([("2024-03-06",), ("2024-03-06",), ("2024-12-25",)], "date string")
    rec = hourly(clean(raw, "date_time", "traffic"), holidays=cal)
    got = sorted((r.date_time, r.is_holiday, r.traffic) for r in rec.collect())
    assert got == [("2024-03-05 01:00:00", 0, 5), ("2024-03-06 02:00:00", 1, 7),
                   ("2024-03-06 05:00:00", 1, 9)]


def test_catalog_table_round_trip(spark, tmp_path):
    from flowtally.sinks import save_result_table
    from flowtally.sources import read_result_table
    h = event_hourly(spark, SF_SMALL)
    base = hourly_baseline(h, SERIES)
    back = save_result_table(base, "flowtally_test_baseline", "batch_hourly_baseline",
                             str(tmp_path / "tbl"), series=SERIES)
    assert back.count() == base.count()
    got = read_result_table(spark, "flowtally_test_baseline", "batch_hourly_baseline", SERIES)
    assert got.columns == ["series", "is_holiday", "hour", "avg_traffic"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, base.collect()))
    spark.sql("DROP TABLE flowtally_test_baseline")


def test_cluster_settings_are_valid_runtime_confs(spark):
    from flowtally.session import CLUSTER_CONF
    before = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    try:
        for k, v in CLUSTER_CONF.items():
            assert spark.conf.isModifiable(k), k
            spark.conf.set(k, v)
            assert spark.conf.get(k) == v
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_null_series_is_a_group_of_its_own(spark):
    from flowtally.plans import check_high, check_normal
    raw = spark.createDataFrame([(None, "2024-03-05 01:00:00", 5), (None, "2024-03-06 01:00:00", 15),
                                 ("a", "2024-03-05 01:00:00", 7)],
                                "series string, date_time string, traffic long")
    rec = hourly(clean(raw, "date_time", "traffic", ["series"]), ["series"], holidays=None)
    base = hourly_baseline(rec, ["series"])
    got = {(r.series, r.date_time): (r.baseline, r.alert_status)
           for r in alerts(rec, base, ["series"]).collect()}
    assert got == {(None, "2024-03-05 01:00:00"): (10.0, "LOW_ALERT"),  # 5 / 10 = 0.5
                   (None, "2024-03-06 01:00:00"): (10.0, "HIGH_ALERT"),
                   ("a", "2024-03-05 01:00:00"): (7.0, "NORMAL")}
    a = alerts(rec, base, ["series"])
    assert check_high(a, base, ["series"]).first().invalid_count == 0
    assert check_normal(a, base, ["series"]).first().total_normal == 1
    # null-safe keys stay equi-join keys: AQE still broadcasts the small side
    from flowtally.plans.inspect import executed_plan_text
    final = executed_plan_text(alerts(rec, base, ["series"]))
    assert "BroadcastHashJoin" in final.split("Initial Plan")[0]
