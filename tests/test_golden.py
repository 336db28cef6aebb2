"""Golden tests: the reference's shipped result rows reproduced."""

import pytest
from pyspark.sql import types as T

from flowtally.fixed import DAY_TYPE_HOLIDAY, DAY_TYPE_ORDINARY
from flowtally.operators import (alerts, clean, cumulative_curve, daily_total, hourly,
                                 rolling_mean, running_day_mean)
from flowtally.plans import (alert_distribution, check_endpoint, check_high, check_low,
                             check_normal, holiday_diff)
from flowtally.streaming import cumulative_stream, run_to_table, running_day_mean_stream

from tests import golden


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(f"{d} {h:02d}:00:00", t) for d, h, t in golden.hourly_traffic()]
    return spark.createDataFrame(rows, "date_time string, traffic_volume long")


@pytest.fixture(scope="module")
def rec(raw):
    return hourly(clean(raw, "date_time", "traffic_volume"), holidays=["2012-12-25"])


@pytest.fixture(scope="module")
def baseline(spark):
    rows = []
    for hour, (ordinary, holiday, _) in golden.BASELINE.items():
        rows += [(0, hour, float(ordinary)), (1, hour, float(holiday))]
    return spark.createDataFrame(rows, "is_holiday int, hour int, avg_traffic double")


def test_cumulative_curve(rec):
    got = {(r.date, r.hour): r.cumulative_traffic for r in cumulative_curve(rec).collect()}
    for date, curve in golden.CURVE.items():
        assert [got[(date, h)] for h in range(24)] == curve


def test_daily_totals(rec):
    got = {r.date: (r.is_holiday, r.total_daily_traffic) for r in daily_total(rec).collect()}
    assert got == golden.TOTALS


def test_holiday_diff(baseline):
    got = {r.hour: r.diff_percent for r in holiday_diff(baseline).collect()}
    assert got == {h: v[2] for h, v in golden.BASELINE.items()}


def test_alert_classes_and_checks(rec, baseline):
    a = alerts(rec, baseline)
    rows = a.collect()
    for date in golden.CURVE:
        hi = {r.hour for r in rows if r.date_time.startswith(date) and r.alert_status == "HIGH_ALERT"}
        lo = {r.hour for r in rows if r.date_time.startswith(date) and r.alert_status == "LOW_ALERT"}
        assert hi == golden.HIGH_HOURS[date] and lo == golden.LOW_HOURS[date]
    dist = {r.alert_status: r.record_count for r in alert_distribution(a).collect()}
    assert dist == {"HIGH_ALERT": 2, "LOW_ALERT": 6, "NORMAL": 40}
    assert check_high(a, baseline).first().invalid_count == 0
    assert check_low(a, baseline).first().invalid_count == 0
    assert tuple(check_normal(a, baseline).first()) == (40, 0, 0, 40)


def test_endpoint_check(rec):
    rows = check_endpoint(daily_total(rec), cumulative_curve(rec)).collect()
    got = {r.date: (r.day_type, r.batch_total, r.stream_final, r.diff) for r in rows}
    assert got == {"2012-10-10": (DAY_TYPE_ORDINARY, 91262, 91262, 0),
                   "2012-12-25": (DAY_TYPE_HOLIDAY, 39604, 39604, 0)}


def test_running_and_rolling_means(rec):
    day = {r.current_time: r for r in running_day_mean(rec).collect()}
    for (date, hour), mean in golden.DAY_MEAN.items():
        assert day[f"{date} {hour:02d}:00:00"].avg_traffic == pytest.approx(mean, abs=1e-3)
    roll = {r.current_time: r for r in rolling_mean(rec).collect()}
    end = roll["2012-10-10 23:00:00"]
    assert end.data_count == 24 and end.window_start == "2012-10-10 00:00:00"
    assert end.avg_traffic == pytest.approx(3802.583, abs=1e-3)
    assert roll["2012-12-25 23:00:00"].avg_traffic == pytest.approx(1650.167, abs=1e-3)
    assert roll["2012-12-25 05:00:00"].data_count == 6


def test_stream_curve_and_day_mean_match_golden(spark, raw, scratch):
    path = f"{scratch}/in"
    raw.repartition(3).write.parquet(path)
    schema = T.StructType([T.StructField("date_time", T.StringType()),
                           T.StructField("traffic_volume", T.LongType())])
    stream = clean(spark.readStream.schema(schema).parquet(path), "date_time", "traffic_volume")
    curve = run_to_table(spark, cumulative_stream(stream, holidays=["2012-12-25"]), "g",
                         f"{scratch}/curve")
    got = {(r.date, r.hour): (r.cumulative_traffic, r.is_holiday) for r in curve.collect()}
    for date, c in golden.CURVE.items():
        flag = golden.TOTALS[date][0]
        assert [got[(date, h)] for h in range(24)] == [(v, flag) for v in c]
    means = run_to_table(spark, running_day_mean_stream(stream), "m", f"{scratch}/mean")
    day = {r.current_time: r.avg_traffic for r in means.collect()}
    for (date, hour), mean in golden.DAY_MEAN.items():
        assert day[f"{date} {hour:02d}:00:00"] == pytest.approx(mean, abs=1e-3)
