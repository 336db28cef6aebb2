"""The table merged by key (K3): bounded files, killed commits, readers."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtally.operators import cumulative_curve
from flowtally.queries import _unordered
from flowtally.sinks.keyed import KeyedTable
from flowtally.sources.testdata import SERIES, event_hourly
from flowtally.streaming import cumulative_stream, run_to_table
from flowtally.streaming.runner import output_schema
from tests.conftest import SF_SMALL

SCHEMA = T.StructType([T.StructField("date", T.StringType()), T.StructField("n", T.LongType()),
                       T.StructField("note", T.StringType())])


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, items):
    return spark.createDataFrame(items, SCHEMA)


def a_table(spark, scratch, **more):
    return KeyedTable(spark, f"{scratch}/t", SCHEMA, ["date"], "substring(date, 1, 7)", **more)


def test_a_key_written_often_is_read_from_few_files(spark, scratch):
    table, want = a_table(spark, scratch, deltas=3, splits=2), {}
    for i in range(12):
        items = [("2024-01-01", i, f"x{i}"), (f"2024-0{1 + i % 3}-09", i, None)]
        assert table.add(frame(spark, items), batch=i)
        want.update({d: (d, n, s) for d, n, s in items})
        live = [e for e in table.entries() if e.kind == "live"]
        assert all(sum(e.range == r for e in live) <= 3 for r in {e.range for e in live})
    assert rows(table.read()) == sorted(want.values())
    files = sum(len([f for f in os.listdir(e.path) if f.endswith(".parquet")]) for e in live)
    assert files <= 3 * 3 * 2


def test_a_batch_counts_once(spark, scratch):
    table = a_table(spark, scratch)
    assert table.add(frame(spark, [("2024-01-01", 1, "a")]), batch=4)
    assert not table.add(frame(spark, [("2024-01-01", 2, "b")]), batch=4)
    assert not table.add(frame(spark, [("2024-01-01", 2, "b")]), batch=3)
    assert rows(table.read()) == [("2024-01-01", 1, "a")]
    assert table.add(frame(spark, []), batch=5) and table.add(frame(spark, [("2024-01-01", None, None)]), batch=6)
    assert rows(table.read()) == [("2024-01-01", None, None)]


def test_a_killed_commit_or_merge_changes_nothing(spark, scratch, monkeypatch):
    table = a_table(spark, scratch, deltas=9)
    for i in range(4):
        table.add(frame(spark, [("2024-01-01", i, "x"), (f"2024-02-0{i + 1}", i, "y")]), batch=i)
    before, version = rows(table.read()), table.version()

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_commit", killed)
        for step in (lambda: table.merge(deltas=1), lambda: table.add(frame(spark, [("2024-01-01", 9, "z")]), batch=9)):
            with pytest.raises(KeyboardInterrupt):
                step()
    assert (rows(table.read()), table.version()) == (before, version)
    # A version without its end mark does not count either, and is written over.
    os.makedirs(f"{scratch}/t/manifest/v={version + 1}")
    assert rows(table.read()) == before
    assert table.merge(deltas=1) == ["_range=2024-01", "_range=2024-02"] and rows(table.read()) == before
    assert len([e for e in table.entries() if e.kind == "live"]) == 2


def test_readers_keep_their_version_until_the_grace_is_over(spark, scratch):
    table = a_table(spark, scratch, deltas=9)
    for i in range(3):
        table.add(frame(spark, [("2024-01-01", i, "x")]), batch=i)
    reader, want = table.read(), rows(table.read())
    table.merge(deltas=1)
    assert table.vacuum(grace=3600) == 0 and rows(reader) == want
    stored = len(os.listdir(f"{scratch}/t/data"))
    table.vacuum(grace=-1)
    assert rows(table.read()) == want and len(os.listdir(f"{scratch}/t/data")) < stored
    assert table.add(frame(spark, [("2024-01-02", 7, "x")]), batch=3) and len(rows(table.read())) == 2


def test_sums_add_up_and_null_ranges_count(spark, scratch):
    table = a_table(spark, scratch, rule={"n": "sum", "note": "max"}, deltas=2)
    for i in range(5):
        table.add(frame(spark, [("2024-01-01", i, str(i)), (None, 1, None)]))
    assert sorted(tuple(r) for r in table.read().where("date IS NOT NULL").collect()) == [("2024-01-01", 10, "4")]
    assert [tuple(r) for r in table.read().where("date IS NULL").collect()] == [(None, 5, None)]


def test_another_writer_is_refused(spark, scratch, monkeypatch):
    one, two = a_table(spark, scratch), a_table(spark, scratch)
    one.add(frame(spark, [("2024-01-01", 1, "a")]))
    stale = one.version()
    two.add(frame(spark, [("2024-01-01", 2, "b")]))
    monkeypatch.setattr(KeyedTable, "version", lambda self: stale)
    with pytest.raises(RuntimeError, match="another writer"):
        one.add(frame(spark, [("2024-01-01", 3, "c")]))


def test_empty(spark, scratch):
    table = a_table(spark, scratch)
    assert rows(table.read()) == [] and table.version() == 0 and table.merge() == [] and table.vacuum() == 0


def test_stream_into_a_keyed_table(spark, scratch):
    plan = cumulative_stream(_unordered(spark, SF_SMALL, files=7), SERIES, lateness="40 days")
    table = KeyedTable(spark, f"{scratch}/t", output_schema(spark, plan), plan.keys, "substring(date, 1, 7)", deltas=2)
    got = run_to_table(spark, plan, "keyed", f"{scratch}/run", table=table)
    want = cumulative_curve(event_hourly(spark, SF_SMALL), SERIES)
    assert rows(got.select(*want.columns)) == rows(want)
    ranges = [e.range for e in table.entries() if e.kind == "live"]
    assert all(ranges.count(r) <= 2 for r in ranges)
    # The same batches once more, after their checkpoint is lost: nothing is added twice.
    version = table.version()
    again = run_to_table(spark, plan, "keyed", f"{scratch}/again", table=table)
    assert rows(again.select(*want.columns)) == rows(want) and table.version() == version


def test_days_are_ranges_too(spark, scratch):
    schema = T.StructType([T.StructField("day", T.DateType()), T.StructField("n", T.LongType())])
    table = KeyedTable(spark, f"{scratch}/d", schema, ["day"], F.col("day"), {"n": "sum"}, deltas=1)
    for i in range(3):
        table.add(spark.createDataFrame([(dt.date(2024, 1, 1 + i), 1), (dt.date(2024, 1, 1), 1)], schema))
    assert rows(table.read())[0] == (dt.date(2024, 1, 1), 4)
