"""The command line end to end: batch -> four stream jobs -> checks."""

from flowtally.cli import main
from flowtally.operators import cumulative_curve, daily_total, hourly_baseline, rolling_mean
from flowtally.sources.testdata import SERIES, event_hourly
from tests.conftest import SF_SMALL

COMMON = ["--time-col", "ts", "--value", "round(value * 100)", "--series", "event_type"]


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_batch_stream_check(spark, tmp_path):
    events = f"{SF_SMALL}/events.parquet"
    out = str(tmp_path)
    batch = main(["batch", "--input", events, *COMMON, "--out", f"{out}/batch"], spark)
    h = event_hourly(spark, SF_SMALL).withColumnRenamed("series", "event_type")
    want = hourly_baseline(h, ["event_type"])
    assert _rows(batch["batch_hourly_baseline"], want.columns) == _rows(want, want.columns)
    back = spark.read.option("header", True).csv(f"{out}/batch/batch_daily_total")
    assert back.columns == ["event_type", "date", "is_holiday", "total_daily_traffic"]
    assert back.count() == daily_total(h, ["event_type"]).count()

    streams = {}
    for job in ("alerts", "rolling", "cumulative", "day_mean"):
        extra = ["--baseline", f"{out}/batch", "--grain", "hour"] if job == "alerts" else []
        streams[job] = main(["stream", "--input", events, *COMMON, "--job", job, *extra,
                             "--out", f"{out}/stream"], spark)
    roll = rolling_mean(h, ["event_type"])
    assert _rows(streams["rolling"], roll.columns) == _rows(roll, roll.columns)
    curve = cumulative_curve(h, ["event_type"])
    assert _rows(streams["cumulative"], curve.columns) == _rows(curve, curve.columns)
    assert streams["alerts"].count() == h.count()

    assert main(["compact", "--stream", f"{out}/stream", "--job", "cumulative",
                 "--series", "event_type"], spark) == 0
    checks = main(["check", "--batch", f"{out}/batch", "--stream", f"{out}/stream",
                   "--series", "event_type", "--out", f"{out}/checks"], spark)
    assert checks["check_high"].first().invalid_count == 0
    assert checks["check_low"].first().invalid_count == 0
    assert all(r.diff == 0 for r in checks["check_endpoint"].collect())
    assert sum(r.record_count for r in checks["alert_distribution"].collect()) == h.count()
    assert checks["check_convergence"].count() == roll.count()
    assert {r.table_name for r in checks["import_counts"].collect()} == {
        "batch_hourly_baseline", "batch_daily_average", "batch_daily_total"}
    assert SERIES == ("series",)

    gap, n, top = main([
        "sql", "--batch", f"{out}/batch", "--stream", f"{out}/stream", "--series", "event_type",
        "-e", "SELECT c.event_type, c.date, t.total_daily_traffic - c.cumulative_traffic AS gap "
        "FROM flink_cumulative_result c JOIN batch_daily_total t "
        "ON c.event_type = t.event_type AND c.date = t.date WHERE c.hour = 23",
        "-e", "SELECT COUNT(*) AS n FROM flink_alert_result",
        "-e", "SELECT MAX(data_count) AS m, MIN(`current_time`) AS first FROM flink_rolling_avg_result",
    ], spark)
    gaps = gap.collect()
    assert gaps and all(r.gap == 0 for r in gaps)
    assert n.first().n == h.count()
    assert top.first().m <= 24


def test_golden_rows_through_the_command_line(spark, tmp_path):
    """The reference's shipped curve, replayed as a raw CSV through batch ->
    stream -> sql, with parquet outputs."""
    from tests import golden

    raw = tmp_path / "raw"
    raw.mkdir()
    lines = ["date_time,traffic_volume"] + [
        f"{d} {h:02d}:00:00,{t}" for d, h, t in golden.hourly_traffic()]
    (raw / "traffic.csv").write_text("\n".join(lines) + "\n")
    args = ["--input", str(raw), "--input-format", "csv", "--time-col", "date_time",
            "--value", "traffic_volume", "--holidays", "2012-12-25", "--format", "parquet"]
    out = str(tmp_path)
    main(["batch", *args, "--out", f"{out}/batch"], spark)
    main(["stream", *args, "--job", "cumulative", "--out", f"{out}/stream"], spark)
    ends, totals = main([
        "sql", "--batch", f"{out}/batch", "--stream", f"{out}/stream", "--format", "parquet",
        "-e", "SELECT date, cumulative_traffic, is_holiday FROM flink_cumulative_result "
              "WHERE hour = 23",
        "-e", "SELECT date, total_daily_traffic, is_holiday FROM batch_daily_total"], spark)
    want = {d: (t, flag) for d, (flag, t) in golden.TOTALS.items()}
    exported = main(["export", "--batch", f"{out}/batch", "--stream", f"{out}/stream",
                     "--format", "parquet", "--out", f"{out}/csv"], spark)
    assert set(exported) == {"batch_hourly_baseline", "batch_daily_average",
                             "batch_daily_total", "flink_cumulative_result"}
    files = list((tmp_path / "csv" / "flink_cumulative_result").glob("*.csv"))
    assert len(files) == 1
    lines = files[0].read_text().splitlines()
    assert lines[0] == "date,hour,cumulative_traffic,is_holiday" and len(lines) == 49
    assert {r.date: (r.cumulative_traffic, r.is_holiday) for r in ends.collect()} == want
    assert {r.date: (r.total_daily_traffic, r.is_holiday) for r in totals.collect()} == want


def test_late_rows_merged_tables_and_versions(spark, tmp_path):
    """Files one after the other: incremental batch, published baseline
    versions, a stream that stores late rows and merges by key, a replay in
    the order of times, and SQL over the merged tables."""
    from pyspark.sql import functions as F

    from flowtally.operators.asof import alerts_asof
    from flowtally.sources.testdata import table

    out, events = str(tmp_path), table(spark, SF_SMALL, "events")
    h = event_hourly(spark, SF_SMALL).withColumnRenamed("series", "event_type")
    for k in range(3):
        events.where(F.col("event_id") % 3 == k).coalesce(1).write.mode("append").parquet(f"{out}/in")
        batch = main(["batch", "--input", f"{out}/in", *COMMON, "--state", f"{out}/state", "--out", f"{out}/batch"], spark)
    want = hourly_baseline(h, ["event_type"])
    assert _rows(batch["batch_hourly_baseline"], want.columns) == _rows(want, want.columns)

    for at in ("2024-01-08 00:00:00", "2024-01-20 00:00:00"):
        versions = main(["publish", "--batch", f"{out}/batch", "--valid-from", at, "--versions", f"{out}/versions",
                         "--series", "event_type"], spark)
    stream = ["stream", "--input", f"{out}/in", *COMMON, "--merge", "--out", f"{out}/stream"]
    got = main([*stream, "--job", "alerts", "--versions", f"{out}/versions"], spark)
    want = alerts_asof(h, versions, ["event_type"])
    assert _rows(got, want.columns) == _rows(want, want.columns)

    got = main([*stream, "--job", "cumulative", "--late", "store", "--lateness", "1 day"], spark)
    curve = cumulative_curve(h, ["event_type"])
    assert got.count() == curve.count()      # one micro-batch: nothing was late
    got = main([*stream, "--job", "rolling", "--in-order"], spark)
    roll = rolling_mean(h, ["event_type"])
    assert _rows(got, roll.columns) == _rows(roll, roll.columns)
    n, = main(["sql", "--stream", f"{out}/stream", "--series", "event_type",
               "-e", "SELECT COUNT(*) AS n FROM flink_cumulative_result"], spark)
    assert n.first().n == curve.count()
