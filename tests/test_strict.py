"""Failures are loud, and what a check cannot see is counted."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from flowtally.cli import main
from flowtally.operators import alerts, clean, cumulative_curve, daily_total, hourly, hourly_baseline
from flowtally.operators.prepare import rejected
from flowtally.plans.checks import endpoint_coverage, import_check
from flowtally.plans.inspect import plan_text
from flowtally.plans.views import stream_result
from flowtally.session import checkpoint_root
from flowtally.sources.stream import list_names, path_kind
from flowtally.sources.testdata import SERIES, event_hourly, table
from flowtally.streaming import read_latest
from tests.conftest import SF_SMALL

SCHEMA = "k string, v long"


def test_only_a_missing_folder_reads_as_empty(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    assert read_latest(spark, str(tmp_path / "none"), ["k"], schema).count() == 0
    bad = tmp_path / "out" / "batch_id=0"
    bad.mkdir(parents=True)
    (bad / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_latest(spark, str(tmp_path / "out"), ["k"], schema).collect()
    with pytest.raises(Exception):      # a check over an absent result fails
        stream_result(spark, str(tmp_path), "alerts", ())


def test_file_system_errors_are_raised(spark, tmp_path):
    assert path_kind(spark, str(tmp_path / "none")) is None and list_names(spark, str(tmp_path / "none")) == []
    assert path_kind(spark, str(tmp_path)) == "dir"
    with pytest.raises(Exception):
        path_kind(spark, "nosuchscheme://host/x")
    with pytest.raises(Exception):
        list_names(spark, "nosuchscheme://host/x")


def test_a_cluster_needs_a_shared_folder():
    class Dir:
        def isDefined(self):
            return False

    class Context:
        master = "spark://host:7077"

        class _jsc:
            @staticmethod
            def sc():
                return type("S", (), {"getCheckpointDir": staticmethod(Dir)})

    class Session:
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: None)})
        sparkContext = Context

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session)


def test_repeated_baseline_keys_fail(spark):
    h = event_hourly(spark, SF_SMALL)
    base = hourly_baseline(h, SERIES)
    with pytest.raises(Exception, match="more than one row"):
        alerts(h, base.unionByName(base), SERIES).collect()


def test_lost_days_are_counted(spark):
    h = event_hourly(spark, SF_SMALL)
    total, curve = daily_total(h, SERIES), cumulative_curve(h, SERIES)
    day = total.agg(F.min("date")).first()[0]
    whole = endpoint_coverage(total, curve, SERIES, endpoint_hour=None).first()
    assert whole.totals_without_end == whole.ends_without_total == 0
    lost = endpoint_coverage(total, curve.where(F.col("date") != day), SERIES, endpoint_hour=None).first()
    n = total.where(F.col("date") == day).count()
    assert lost.totals_without_end == n and lost.both_sides == whole.both_sides - n
    other = endpoint_coverage(total.where(F.col("date") != day), curve, SERIES, endpoint_hour=None).first()
    assert other.ends_without_total == n


def test_import_check_sees_changed_values(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), ("y", 2)], SCHEMA)
    b = spark.createDataFrame([("x", 1), ("y", 3), ("y", 2)], SCHEMA)
    assert tuple(import_check({"t": a}, {"t": a}).first()) == ("t", 3, 3, 0)
    assert tuple(import_check({"t": a}, {"t": b}).first()) == ("t", 3, 3, 2)


def test_bad_values_are_dropped_and_kept_aside(spark):
    raw = spark.createDataFrame([("2024-01-01 00:00:00", "5"), ("2024-01-01 01:00:00", "abc"),
                                 ("not a time", "7"), (None, "1"), ("2024-01-01 02:00:00", None)],
                                "t string, v string")
    assert clean(raw, "t", "v").count() == 1
    bad = rejected(raw, "t", "v").collect()
    assert sorted(r.reject_reason for r in bad) == ["time", "time", "value", "value"]
    assert len(bad) + clean(raw, "t", "v").count() == raw.count()


def test_chosen_dates_reach_the_scan(spark):
    df = clean(table(spark, SF_SMALL, "events"), "ts", F.col("value"), dates=["2024-01-02", "2024-01-05"])
    txt = plan_text(df)
    assert "Or(And(GreaterThanOrEqual(ts" in txt.replace("PushedFilters: [", "PushedFilters: [ ")
    assert {str(r.ts)[:10] for r in df.collect()} == {"2024-01-02", "2024-01-05"}


def test_one_shuffle_for_the_daily_total(spark):
    txt = plan_text(entry.queries()["daily_total"](spark, SF_SMALL), "simple")
    assert txt.count("Exchange") == 1


def test_result_reads_hash_aggregate(spark, tmp_path):
    out = str(tmp_path / "out")
    for i in range(3):
        spark.createDataFrame([("a", i)], "k string, v long").write.parquet(f"{out}/batch_id={i}")
    df = read_latest(spark, out, ["k"], spark.createDataFrame([], SCHEMA).schema)
    assert "SortAggregate" not in plan_text(df, "simple") and df.first().v == 2


def test_ordered_results_are_in_order(spark):
    curve = [(r.series, r.date, r.hour) for r in entry.queries()["curve_ordered"](spark, SF_SMALL).collect()]
    diff = [(r.series, r.hour) for r in entry.queries()["holiday_diff"](spark, SF_SMALL).collect()]
    conv = [(r.series, r["current_time"]) for r in
            entry.queries()["check_convergence"](spark, SF_SMALL).collect()]
    top = [(r["current_time"], r.series) for r in entry.queries()["rolling_topk"](spark, SF_SMALL).collect()]
    for rows in (curve, diff, conv, top):
        assert rows and rows == sorted(rows)


def _raw_csv(folder):
    os.makedirs(folder)
    lines = ["date_time,holiday,traffic_volume"]
    for day, mark in (("2023-03-01", "None"), ("2023-03-02", "Local Day"), ("2023-03-03", "None")):
        for hour in range(24):
            label = mark if hour == 0 else "None"
            lines += [f"{day} {hour:02d}:00:00,{label},{100 + hour}"] * (2 if hour == 5 else 1)
    lines += ["2023-03-03 07:00:00,None,n/a", "bad time,None,5"]
    with open(f"{folder}/traffic.csv", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_a_raw_traffic_file_through_the_command_line(spark, tmp_path):
    """Marked days, repeated rows and bad cells, batch and stream alike."""
    out = str(tmp_path)
    _raw_csv(f"{out}/raw")
    args = ["--input", f"{out}/raw", "--input-format", "csv", "--time-col", "date_time",
            "--value", "traffic_volume", "--marker", "holiday <> 'None'", "--combine", "max",
            "--schema", "date_time string, holiday string, traffic_volume string", "--format", "parquet"]
    main(["batch", *args, "--out", f"{out}/batch"], spark)
    totals = {r.date: (r.total_daily_traffic, r.is_holiday)
              for r in spark.read.parquet(f"{out}/batch/batch_daily_total").collect()}
    day = sum(100 + h for h in range(24))
    assert totals == {"2023-03-01": (day, 0), "2023-03-02": (day, 1), "2023-03-03": (day, 0)}
    reasons = sorted(r.reject_reason for r in spark.read.parquet(f"{out}/batch/rejected").collect())
    assert reasons == ["time", "value"]
    for mode in ("update", "append"):
        curve = main(["stream", *args, "--job", "cumulative", "--mode", mode, "--out", f"{out}/{mode}"], spark)
        ends = {r.date: (r.cumulative_traffic, r.is_holiday) for r in curve.where("hour = 23").collect()}
        assert ends == totals and curve.count() == 72


def test_record_alerts_never_change_class(spark, tmp_path):
    """An hour split over files is classified record by record: the records of
    the first file keep their class when the second arrives."""
    base = spark.createDataFrame([(0, h, 10.0) for h in range(24)],
                                 "is_holiday int, hour int, avg_traffic double")
    base.write.parquet(str(tmp_path / "batch" / "batch_hourly_baseline"))
    rows = [(f"2023-03-01 08:{m:02d}:00", 10 if m % 7 else 50) for m in range(60)]
    src = str(tmp_path / "src")
    args = ["stream", "--input", src, "--time-col", "t", "--value", "v", "--job", "alerts",
            "--baseline", str(tmp_path / "batch"), "--format", "parquet", "--out", str(tmp_path / "s")]
    spark.createDataFrame(rows[:30], "t string, v long").coalesce(1).write.mode("append").parquet(src)
    first = {r.date_time: r.alert_status for r in main(args, spark).collect()}
    spark.createDataFrame(rows[30:], "t string, v long").coalesce(1).write.mode("append").parquet(src)
    both = {r.date_time: r.alert_status for r in main(args, spark).collect()}
    assert len(first) == 30 and len(both) == 60 and all(both[t] == c for t, c in first.items())
    assert both == {t: "HIGH_ALERT" if v == 50 else "NORMAL" for t, v in rows}


def test_stored_hours_are_the_batch_input(spark):
    h = event_hourly(spark, SF_SMALL)
    again = hourly(clean(table(spark, SF_SMALL, "events"), "ts", F.round(F.col("value") * 100),
                         {"series": "event_type"}), SERIES)
    assert h.exceptAll(again).count() == 0
