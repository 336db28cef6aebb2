"""Late rows are kept whole: kept and late rows are the input, exactly."""

import pytest
from pyspark.sql import functions as F

from flowtally.operators import alerts, cumulative_curve, hourly, hourly_baseline, rolling_mean
from flowtally.queries import _files_in_turn
from flowtally.sinks import write_table
from flowtally.sources.stream import FileInput
from flowtally.sources.testdata import SERIES, event_hourly, events_clean, table
from flowtally.streaming import (LateRows, alerts_stream, cumulative_stream, read_late, rolling_stream, run_to_table)
from flowtally.streaming import runner
from tests.conftest import SF_SMALL

COUNTS = "ts IS NOT NULL AND value IS NOT NULL"


@pytest.fixture(scope="module")
def in_turn(spark):
    return _files_in_turn(spark, SF_SMALL, 4)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def split(spark, source, make, lateness, root):
    late = LateRows(source, "ts", COUNTS)
    plan = make(events_clean(source.stream(spark, 1)), lateness)
    stats = {}
    got = run_to_table(spark, plan, "late", root, late="store", late_rows=late, stats=stats)
    found = read_late(spark, f"{root}/late", late)
    kept = table(spark, SF_SMALL, "events").where(COUNTS).join(found.select("event_id"), "event_id", "left_anti")
    assert kept.count() + found.count() == table(spark, SF_SMALL, "events").where(COUNTS).count()
    assert found.count() == found.select("event_id").distinct().count()
    assert (stats["dropped_late_groups"] > 0) == (found.count() > 0)
    return got, kept, found


@pytest.mark.parametrize("lateness", ["0 seconds", "3 days", "40 days"])
def test_curve(spark, in_turn, tmp_path, lateness):
    got, kept, found = split(spark, in_turn, lambda s, late: cumulative_stream(s, SERIES, lateness=late),
                             lateness, str(tmp_path))
    want = cumulative_curve(hourly(events_clean(kept), SERIES), SERIES)
    assert rows(got.select(*want.columns)) == rows(want)
    assert (found.count() == 0) == (lateness == "40 days")
    # Whole rows, as they are in the input.
    raw = table(spark, SF_SMALL, "events")
    assert found.select(*raw.columns).exceptAll(raw).count() == 0


def test_alerts(spark, in_turn, tmp_path):
    base = write_table(hourly_baseline(event_hourly(spark, SF_SMALL), SERIES), f"{tmp_path}/base")
    got, kept, _ = split(spark, in_turn, lambda s, late: alerts_stream(s, base, SERIES, lateness=late),
                         "2 days", f"{tmp_path}/run")
    want = alerts(hourly(events_clean(kept), SERIES), base, SERIES)
    assert rows(got.select(*want.columns)) == rows(want)


def test_rolling(spark, in_turn, tmp_path):
    """A late row's first window had ended; the next day's window may still
    take it, so days after a late row's are left out of the comparison."""
    got, kept, found = split(spark, in_turn, lambda s, late: rolling_stream(s, SERIES, lateness=late),
                             "3 days", str(tmp_path))
    want = rolling_mean(hourly(events_clean(kept), SERIES), SERIES)
    last = found.agg(F.max("closed_at")).first()[0]
    after = (F.to_timestamp("current_time") >= F.lit(last) + F.expr("interval 1 day"))
    assert rows(got.where(after).select(*want.columns)) == rows(want.where(after)) != []


def test_replayed_batch_stores_the_same(spark, in_turn, tmp_path):
    make = lambda s, late: cumulative_stream(s, SERIES, lateness=late)
    _, _, found = split(spark, in_turn, make, "3 days", str(tmp_path))
    before = rows(found.select("event_id", "batch_id"))
    late = LateRows(in_turn, "ts", COUNTS)
    plan = make(events_clean(in_turn.stream(spark, 1)), "3 days")
    from flowtally.streaming.late import store_late
    for batch in range(4):
        store_late(spark, late, plan.closes, f"{tmp_path}/checkpoint", f"{tmp_path}/late", batch)
    assert rows(read_late(spark, f"{tmp_path}/late", late).select("event_id", "batch_id")) == before


def test_times_as_text(spark, tmp_path):
    """A raw CSV folder: bad cells are no late rows."""
    source = FileInput(f"{tmp_path}/in", "k string, at string, v string", "csv")
    source.schema = spark.createDataFrame([], source.schema).schema
    for day in ("2024-01-20", "2024-01-21", "2024-01-02"):
        spark.createDataFrame([("a", f"{day} 05:00:00", "3"), ("a", f"{day} 06:00:00", "n/a"), ("a", "?", "1")],
                              source.schema).coalesce(1).write.mode("append").option("header", True).csv(source.path)
    from flowtally.operators.prepare import clean
    stream = clean(source.stream(spark, 1), "at", "v", {"series": "k"})
    late = LateRows(source, "at", "try_cast(v AS BIGINT) IS NOT NULL")
    got = run_to_table(spark, cumulative_stream(stream, SERIES, lateness="1 day"), "t", f"{tmp_path}/run",
                       late="store", late_rows=late)
    found = read_late(spark, f"{tmp_path}/run/late", late).collect()
    assert [(r.at, r.v) for r in found] == [("2024-01-02 05:00:00", "3")]
    assert sorted(r.date for r in got.collect()) == ["2024-01-20", "2024-01-21"]


def test_wrong_use(spark, in_turn):
    plan = cumulative_stream(events_clean(in_turn.stream(spark)), SERIES)
    with pytest.raises(ValueError):
        run_to_table(spark, plan, "x", late="store")


def test_too_many_batches_to_know(spark, in_turn, tmp_path, monkeypatch):
    monkeypatch.setattr(runner, "PROGRESS_KEPT", 2)
    plan = cumulative_stream(events_clean(in_turn.stream(spark, 1)), SERIES, lateness="40 days")
    with pytest.raises(RuntimeError, match="not known"):
        run_to_table(spark, plan, "x", f"{tmp_path}/a")
    assert run_to_table(spark, plan, "x", f"{tmp_path}/b", late="report").count() > 0
