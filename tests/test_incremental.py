"""Incremental A1-A3: files are added once, and only once."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtally.operators import daily_average, daily_total, hourly, hourly_baseline
from flowtally.plans.incremental import arrive, hour_state, hour_table, results
from flowtally.sinks.keyed import KeyedTable
from flowtally.sources.testdata import EVENTS_SCHEMA, SERIES, event_hourly, events_clean, table
from tests.conftest import SF_SMALL

FIELD = T.StructType([T.StructField("series", T.StringType())])


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def feed(spark, scratch):
    """Ten files of events, one more with every call; which files were read."""
    seen = []

    def read(paths):
        seen.append(sorted(os.path.basename(p) for p in paths))
        return events_clean(spark.read.schema(EVENTS_SCHEMA).parquet(*paths))

    def more(k):
        table(spark, SF_SMALL, "events").where(F.col("event_id") % 10 == k).coalesce(1) \
            .write.mode("append").parquet(f"{scratch}/in")
    return more, read, seen


def test_ten_arrivals_and_a_repeated_one(spark, scratch, feed):
    more, read, seen = feed
    state = hour_state(spark, f"{scratch}/state", FIELD, deltas=3)
    for k in range(10):
        more(k)
        assert arrive(state, f"{scratch}/in", read, SERIES) == 1
    assert arrive(state, f"{scratch}/in", read, SERIES) == 0
    assert len(seen) == 10 and all(len(s) == 1 for s in seen) and len({s[0] for s in seen}) == 10
    full = event_hourly(spark, SF_SMALL)
    assert rows(hour_table(state, SERIES)) == rows(full)
    got = results(state, SERIES)
    assert rows(got["batch_hourly_baseline"]) == rows(hourly_baseline(full, SERIES))
    assert rows(got["batch_daily_average"]) == rows(daily_average(full, SERIES))
    assert rows(got["batch_daily_total"]) == rows(daily_total(full, SERIES))
    kinds = [e.kind for e in state.entries()]
    assert kinds.count("ledger") <= 3 and kinds.count("live") <= 3 * 2      # 31 days in at most two months


def test_a_killed_arrival_is_made_up_for(spark, scratch, feed, monkeypatch):
    more, read, _ = feed
    state = hour_state(spark, f"{scratch}/state", FIELD)
    for k in range(4):
        more(k)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_commit", killed)
        with pytest.raises(KeyboardInterrupt):
            arrive(state, f"{scratch}/in", read, SERIES)
    assert hour_table(state, SERIES).count() == 0
    assert arrive(state, f"{scratch}/in", read, SERIES, most=3) == 4       # two commits
    want = hourly(events_clean(table(spark, SF_SMALL, "events").where("event_id % 10 < 4")), SERIES)
    assert rows(hour_table(state, SERIES)) == rows(want)


def test_a_changed_file_fails(spark, scratch, feed):
    more, read, _ = feed
    state = hour_state(spark, f"{scratch}/state", FIELD)
    more(0)
    arrive(state, f"{scratch}/in", read, SERIES)
    name = next(n for n in os.listdir(f"{scratch}/in") if n.endswith(".parquet"))
    os.utime(f"{scratch}/in/{name}", (1, 1))
    with pytest.raises(RuntimeError, match="changed"):
        arrive(state, f"{scratch}/in", read, SERIES)


def test_largest_reading_and_markers(spark, scratch):
    """Repeated readings of an hour over several files count once; a marker
    in any file flags its day."""
    from flowtally.operators import clean
    schema = "series string, at string, v long, off int"
    parts = [[("a", "2024-03-01 00:10:00", 5, 1), ("a", "2024-03-01 05:00:00", 7, 0)],
             [("a", "2024-03-01 05:30:00", 9, 0), ("a", "2024-03-02 05:00:00", 1, None), (None, "2024-03-02 06:00:00", 2, 0)]]
    state = hour_state(spark, f"{scratch}/state", FIELD, combine="max", marked=True)

    def cleaned(df):
        return clean(df, "at", "v", ["series"], flag=F.col("off"))

    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        arrive(state, f"{scratch}/in", lambda p: cleaned(spark.read.schema(schema).parquet(*p)), SERIES, combine="max")
    want = hourly(cleaned(spark.createDataFrame(parts[0] + parts[1], schema)), SERIES, combine="max")
    assert rows(hour_table(state, SERIES).fillna("-")) == rows(want.fillna("-"))
