"""Physical plans: pruned scans, pushed filters, broadcast of the bounded
side, bounded window partitions, no Python in the hot path."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from flowtally.operators import alerts, clean, hourly, hourly_baseline, rolling_mean
from flowtally.plans.inspect import executed_plan_text, plan_text, scan_columns
from flowtally.sources.testdata import SERIES, event_hourly, table
from tests.conftest import SF_SMALL


def test_events_scan_reads_three_columns(spark):
    cols = scan_columns(event_hourly(spark, SF_SMALL))
    assert cols and all(c == "struct<ts:timestamp_ntz,event_type:string,value:double>"
                        for c in cols)


def test_time_range_reaches_the_scan(spark):
    df = hourly(clean(table(spark, SF_SMALL, "events"), "ts", F.col("value"),
                      time_range=("2024-01-02", "2024-01-03")))
    txt = plan_text(df)
    assert "GreaterThanOrEqual(ts" in txt and "LessThan(ts" in txt


def test_single_series_baseline_is_broadcast(spark):
    h = hourly(clean(table(spark, SF_SMALL, "events"), "ts", F.col("value")))
    txt = executed_plan_text(alerts(h, hourly_baseline(h)))
    assert "BroadcastHashJoin" in txt and "SortMergeJoin" not in txt


def test_rolling_window_partitions_are_bucketed(spark):
    txt = plan_text(rolling_mean(event_hourly(spark, SF_SMALL), SERIES))
    spec = [ln for ln in txt.splitlines() if "windowspecdefinition" in ln]
    assert spec and all("_bucket" in ln for ln in spec)


@pytest.mark.parametrize("name", ["hourly_baseline", "alerts_batch", "rolling24_batch",
                                  "cumulative_batch", "daily_total_lineitem", "holiday_diff"])
def test_no_python_evaluation(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    txt = plan_text(df)
    assert "EvalPython" not in txt and "PythonUDF" not in txt
    final = executed_plan_text(df)
    assert "isFinalPlan=true" in final and "*(" in final  # whole-stage codegen spans


def test_series_baseline_broadcast_is_decided_at_runtime(spark):
    """With series the baseline is not hinted: the static planner (threshold
    off here) picks a shuffle join, AQE turns it into a broadcast once the
    materialised baseline is measured under the adaptive threshold, and with
    that threshold off too the shuffle join stays -- same rows either way."""
    h = event_hourly(spark, SF_SMALL)
    before = {k: spark.conf.get(k, None) for k in
              ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(10 << 20))
        df = alerts(h, hourly_baseline(h, SERIES), SERIES)
        initial = plan_text(df, "simple")
        assert "SortMergeJoin" in initial and "BroadcastHashJoin" not in initial
        final = executed_plan_text(df)
        assert "BroadcastHashJoin" in final.split("Initial Plan")[0]
        rows_bhj = sorted(map(tuple, df.collect()))
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        df2 = alerts(h, hourly_baseline(h, SERIES), SERIES)
        final2 = executed_plan_text(df2)
        assert "SortMergeJoin" in final2.split("Initial Plan")[0]
        assert sorted(map(tuple, df2.collect())) == rows_bhj
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
