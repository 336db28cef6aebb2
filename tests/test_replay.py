"""Replays in time order: the batch result, with state near the overlap."""

import pytest
from pyspark.sql import functions as F

from flowtally.operators import clean, cumulative_curve, hourly
from flowtally.operators.windows import rolling_mean
from flowtally.sources.stream import FileInput
from flowtally.sources.testdata import SERIES, table
from flowtally.streaming import cumulative_stream, replay_in_order, rolling_stream
from flowtally.streaming.replay import file_spans, overlap_lateness, waves
from tests.conftest import SF_SMALL


def shipments(raw):
    return clean(raw, "l_shipdate", F.round(F.col("l_extendedprice") * 100), {"series": "l_returnflag"})


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    """Seven years of line items by date, each file reaching into the next."""
    path = str(tmp_path_factory.mktemp("clustered")) + "/files"
    items = table(spark, SF_SMALL, "lineitem")
    shifted = F.date_add(F.to_date("l_shipdate"), (F.xxhash64("l_orderkey") % 15).cast("int"))
    items.repartitionByRange(40, shifted).write.parquet(path)
    return FileInput(path, items.schema)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("job, twin", [(cumulative_stream, cumulative_curve), (rolling_stream, rolling_mean)])
def test_equal_to_batch_with_little_state(spark, clustered, tmp_path, job, twin):
    stats = {}
    got = replay_in_order(spark, clustered, "l_shipdate",
                          lambda raw, late: job(shipments(raw), SERIES, lateness=late), "r", str(tmp_path),
                          files_per_wave=4, stats=stats)
    want = twin(hourly(shipments(clustered.rows(spark)), SERIES), SERIES)
    assert rows(got.select(*want.columns)) == rows(want)
    days = want.count()
    assert stats["waves"] == 10 and stats["lateness_seconds"] <= 40 * 86400
    assert stats["state_rows"] < days / 2 and stats["dropped_late_groups"] == 0


def test_lateness_is_the_largest_step_back():
    spans = [("a", 0.0, 10.0), ("b", 8.0, 30.0), ("c", 12.0, 14.0), ("d", 31.0, 40.0)]
    assert overlap_lateness(waves(spans, 1)) == "18 seconds"
    assert overlap_lateness(waves(spans, 3)) == "0 seconds"
    assert overlap_lateness(waves([], 3)) == "0 seconds" and waves([], 3) == []


def test_odd_names_and_empty_files(spark, tmp_path):
    schema = table(spark, SF_SMALL, "lineitem").schema
    path = tmp_path / "in"
    items = table(spark, SF_SMALL, "lineitem").where("l_orderkey < 200")
    for i, name in enumerate(["b {x},[1].parquet", "a b%20.parquet", "none.parquet"]):
        part = items.where(F.month("l_shipdate") % 2 == i) if i < 2 else items.where("false")
        part.coalesce(1).write.parquet(f"{tmp_path}/w{i}")
        path.mkdir(exist_ok=True)
        next((tmp_path / f"w{i}").glob("*.parquet")).rename(path / name)
    source = FileInput(str(path), schema)
    assert len(file_spans(spark, source, "l_shipdate")) == 2
    got = replay_in_order(spark, source, "l_shipdate",
                          lambda raw, late: cumulative_stream(shipments(raw), SERIES, lateness=late), "o",
                          f"{tmp_path}/run", files_per_wave=1)
    want = cumulative_curve(hourly(shipments(items), SERIES), SERIES)
    assert rows(got.select(*want.columns)) == rows(want)


def test_append_mode_is_refused(spark, clustered, tmp_path):
    with pytest.raises(ValueError):
        replay_in_order(spark, clustered, "l_shipdate", lambda raw, late: cumulative_stream(
            shipments(raw), SERIES, lateness=late, mode="append"), "a", str(tmp_path))
