"""Randomised checks against brute force in plain Python: trailing means of
any length, the cumulative curve, the running day mean and alert classes,
on sparse random hourly records of several series (one of them hot)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flowtally.fixed import HIGH_ALERT, LOW_ALERT, NORMAL
from flowtally.operators import (alerts, clean, cumulative_curve, hourly, hourly_baseline,
                                 rolling_mean, running_day_mean)

START = dt.datetime(2024, 2, 27)  # crosses a month end and a leap day

records = st.lists(
    st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]),
              st.integers(min_value=0, max_value=24 * 5 - 1),
              st.integers(min_value=0, max_value=1000)),
    min_size=1, max_size=60)

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, rows):
    data = [(s, (START + dt.timedelta(hours=h, minutes=7)).strftime("%Y-%m-%d %H:%M:%S"), v)
            for s, h, v in rows]
    raw = spark.createDataFrame(data, "series string, date_time string, traffic long")
    return hourly(clean(raw, "date_time", "traffic", ["series"]), ["series"], holidays=None)


def _hourly_truth(rows):
    out = {}
    for s, h, v in rows:
        out[(s, h)] = out.get((s, h), 0) + v
    return out


def _stamp(h):
    return (START + dt.timedelta(hours=h)).strftime("%Y-%m-%d %H:00:00")


@SETTINGS
@given(rows=records, hours=st.sampled_from([1, 5, 24, 30, 49]))
def test_rolling_mean_matches_brute_force(spark, rows, hours):
    truth = _hourly_truth(rows)
    want = {}
    for (s, h) in truth:
        inside = [truth[(s, x)] for x in range(h - hours + 1, h + 1) if (s, x) in truth]
        want[(s, _stamp(h))] = (_stamp(h - hours + 1), sum(inside) / len(inside), len(inside))
    got = {(r.series, r.current_time): (r.window_start, r.avg_traffic, r.data_count)
           for r in rolling_mean(_frame(spark, rows), ["series"], hours=hours).collect()}
    assert got == want


@SETTINGS
@given(rows=records)
def test_curve_and_day_mean_match_brute_force(spark, rows):
    truth = _hourly_truth(rows)
    h = _frame(spark, rows)
    curve = {(r.series, r.date, r.hour): r.cumulative_traffic
             for r in cumulative_curve(h, ["series"]).collect()}
    means = {(r.series, r.current_time): (r.avg_traffic, r.data_count)
             for r in running_day_mean(h, ["series"]).collect()}
    for (s, x), _ in truth.items():
        day = x // 24
        seen = [truth[(s, y)] for y in range(day * 24, x + 1) if (s, y) in truth]
        stamp = _stamp(x)
        assert curve[(s, stamp[:10], x % 24)] == sum(seen)
        assert means[(s, stamp)] == (sum(seen) / len(seen), len(seen))
    assert len(curve) == len(means) == len(truth)


@SETTINGS
@given(rows=records)
def test_alert_classes_match_brute_force(spark, rows):
    truth = _hourly_truth(rows)
    h = _frame(spark, rows)
    base = {}
    for (s, x), v in truth.items():
        base.setdefault((s, x % 24), []).append(v)
    got = {(r.series, r.date_time): r.alert_status
           for r in alerts(h, hourly_baseline(h, ["series"]), ["series"]).collect()}
    for (s, x), v in truth.items():
        vals = base[(s, x % 24)]
        b = sum(vals) / len(vals)
        ratio = None if b == 0 else v / b
        want = (NORMAL if ratio is None else HIGH_ALERT if ratio >= 1.5
                else LOW_ALERT if ratio <= 0.5 else NORMAL)
        assert got[(s, _stamp(x))] == want


@settings(max_examples=4, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=records, hours=st.sampled_from([5, 24, 30]), parts=st.integers(1, 3),
       seed=st.integers(0, 10_000))
def test_streams_equal_batch_on_random_files(spark, tmp_path_factory, rows, hours, parts, seed):
    """Random records split over random files, one file per micro-batch in
    random order: the rolling and cumulative streams equal their twins."""
    import random

    from pyspark.sql import types as T

    from flowtally.sources import file_stream
    from flowtally.streaming import cumulative_stream, rolling_stream, run_to_table

    d = tmp_path_factory.mktemp("prop")
    rng = random.Random(seed)
    shuffled = rows[:]
    rng.shuffle(shuffled)
    data = [(s, (START + dt.timedelta(hours=h, minutes=7)).strftime("%Y-%m-%d %H:%M:%S"), v)
            for s, h, v in shuffled]
    schema = T.StructType([T.StructField("series", T.StringType()),
                           T.StructField("date_time", T.StringType()),
                           T.StructField("traffic", T.LongType())])
    for i in range(parts):
        chunk = data[i::parts]
        if chunk:
            spark.createDataFrame(chunk, schema).coalesce(1).write.parquet(str(d / "src" / f"f{i}"))

    def stream():
        return clean(file_stream(spark, str(d / "src"), schema, max_files_per_trigger=1,
                                 options={"recursiveFileLookup": True}),
                     "date_time", "traffic", ["series"])

    h = _frame(spark, rows)
    roll = run_to_table(spark, rolling_stream(stream(), ["series"], hours=hours,
                                              lateness="30 days"), "p", str(d / "r"))
    want = rolling_mean(h, ["series"], hours=hours)
    assert sorted(map(tuple, roll.select(*want.columns).collect())) == \
        sorted(map(tuple, want.collect()))
    curve = run_to_table(spark, cumulative_stream(stream(), ["series"], holidays=None,
                                                  lateness="30 days"), "c", str(d / "c"))
    want = cumulative_curve(h, ["series"])
    assert sorted(map(tuple, curve.select(*want.columns).collect())) == \
        sorted(map(tuple, want.collect()))
