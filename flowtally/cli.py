"""Command line: the batch side, the stream side and the checks.

    python -m flowtally batch  --input P --time-col ts --value "round(value*100)" \
                               --series event_type --out DIR [--format csv|parquet]
    python -m flowtally stream --input P --job alerts|rolling|cumulative|day_mean \
                               --time-col ts --value ... --series ... --out DIR \
                               [--baseline DIR] [--lateness "1 hour"] [--every "1 minute"] \
                               [--mode update|append]
    python -m flowtally publish --batch DIR --valid-from T --versions DIR --series ...
    python -m flowtally check  --batch DIR --stream DIR --out DIR
    python -m flowtally compact --stream DIR --job J --series ...
    python -m flowtally export --batch DIR --stream DIR --out DIR [--tables ...]
    python -m flowtally sql    --batch DIR --stream DIR -e "SELECT ... FROM batch_daily_total ..."

``batch`` writes ``batch_hourly_baseline``, ``batch_daily_average`` and
``batch_daily_total`` below ``--out`` (one folder each).  ``stream`` keeps
its checkpoint and result table below ``--out/<job>``; without ``--every`` it
replays what is there (``availableNow``) and stops, with it, it runs on that
trigger until stopped, and restarts resume from the checkpoint.  ``--late
store`` keeps rows that come too late, whole; ``--merge`` merges the result by
key into a table of few files; ``--in-order`` replays the files in the order of
their times, with little state.  ``batch --state`` adds only files that are new
to stored hour sums.  ``publish`` adds a baseline version, from the hours before
a time, to those that ``stream --job alerts --versions`` looks up.  ``check``
reads both sides back and writes the check results below ``--out``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtally.operators import clean, daily_average, daily_total, hourly, hourly_baseline
from flowtally.plans import (alert_distribution, check_convergence, check_endpoint, check_high,
                             check_low, check_normal, holiday_diff, import_counts)
from flowtally.plans.checks import endpoint_coverage
from flowtally.plans.views import STREAM_KEYS, register_result_views, stream_result
from flowtally.schemas import RESULT_SCHEMAS, conform
from flowtally.session import build_session
from flowtally.operators.prepare import marked_days, record_stream, rejected
from flowtally.sinks import export_csv, write_csv_parts, write_table
from flowtally.sources import read_raw_csv
from flowtally.functions.time import to_wall_clock
from flowtally.operators.asof import baseline_table, baseline_version
from flowtally.plans.incremental import arrive, hour_state, hour_table, results
from flowtally.sources.stream import FileInput, file_stream
from flowtally.streaming import (LateRows, alerts_stream, alerts_stream_asof, alerts_stream_records,
                                 cumulative_stream, end_marker, replay_in_order, replay_lateness, rolling_stream,
                                 run_to_table, running_day_mean_stream, start, with_end_marker)
from flowtally.streaming.runner import default_state_partitions, merged_table, output_schema, progress_stats
from flowtally.streaming.sink import compact, latest_snapshot, read_latest

STREAM_TABLES = {"alerts": "flink_alert_result", "rolling": "flink_rolling_avg_result",
                 "cumulative": "flink_cumulative_result", "day_mean": "flink_rolling_avg_result"}


def _read_input(spark: SparkSession, path: str, fmt: str,
                schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def _read_raw(spark: SparkSession, args) -> tuple[DataFrame, DataFrame | None, T.StructType]:
    """The input rows, the malformed lines of a CSV file (else None), and the
    schema: ``--schema`` if given; a CSV file without one is read as text."""
    schema = T._parse_datatype_string(args.schema) if args.schema else None
    if args.input_format != "csv":
        df = _read_input(spark, args.input, args.input_format, schema)
        return df, None, df.schema
    if schema is None:
        head = spark.read.option("header", True).option("inferSchema", False).csv(args.input)
        schema = T.StructType([T.StructField(f.name, T.StringType()) for f in head.schema.fields])
    good, bad = read_raw_csv(spark, args.input, schema)
    return good, bad, schema


def _holidays(arg: str | None):
    if arg is None or arg == "us_federal":
        return "us_federal"
    if arg == "none":
        return None
    return [d.strip() for d in arg.split(",") if d.strip()]


def _clean(df: DataFrame, args) -> DataFrame:
    return clean(df, args.time_col, F.expr(args.value), list(args.series),
                 time_format=args.time_format,
                 flag=F.expr(args.marker).cast("int") if args.marker else None)


def _marked(spark: SparkSession, args, root: str):
    """What the stream takes as holidays: the days that the file's own marker
    flags (stored once, as a calendar table), else ``--holidays``."""
    if not args.marker:
        return _holidays(args.holidays)
    return write_table(marked_days(_clean(_read_raw(spark, args)[0], args)), f"{root}/marked_days")


def _write(df: DataFrame, path: str, fmt: str) -> None:
    if fmt == "csv":
        write_csv_parts(df, path)
    else:
        df.write.mode("overwrite").parquet(path)


def _arrived(spark: SparkSession, args) -> dict[str, DataFrame]:
    """The batch results from stored hour sums, after the new files of the
    input were added to them."""
    series, schema = tuple(args.series), _read_raw(spark, args)[2]
    clean_schema = _clean(spark.createDataFrame([], schema), args).schema
    state = hour_state(spark, args.state, T.StructType([clean_schema[s] for s in series]), args.combine,
                       marked=bool(args.marker))
    source = FileInput(args.input, schema, args.input_format)
    added = arrive(state, args.input, lambda paths: _clean(source.rows(spark, paths), args), series, args.combine,
                   f"*.{args.input_format}")
    print(f"{added} new files")
    write_table(hour_table(state, series, _holidays(args.holidays)), f"{args.out}/hourly_records")
    return results(state, series, _holidays(args.holidays), args.rounding)


def run_batch(spark: SparkSession, args) -> dict[str, DataFrame]:
    series = tuple(args.series)
    if args.state:
        out = _arrived(spark, args)
        for name, df in out.items():
            _write(conform(df, name, series), f"{args.out}/{name}", args.format)
        return out
    raw, bad, _ = _read_raw(spark, args)
    # The hourly records are written once; the results read these.
    rec = write_table(hourly(_clean(raw, args), list(args.series), _holidays(args.holidays),
                             combine=args.combine), f"{args.out}/hourly_records")
    rejected(raw, args.time_col, F.expr(args.value), args.time_format).write.mode("overwrite") \
        .parquet(f"{args.out}/rejected")
    if bad is not None:
        bad.write.mode("overwrite").parquet(f"{args.out}/malformed")
    tables = {
        "batch_hourly_baseline": hourly_baseline(rec, series, rounding=args.rounding),
        "batch_daily_average": daily_average(rec, series),
        "batch_daily_total": daily_total(rec, series),
    }
    for name, df in tables.items():
        _write(conform(df, name, series), f"{args.out}/{name}", args.format)
    return tables


def run_publish(spark: SparkSession, args) -> DataFrame:
    """Add the baseline of the hours before ``--valid-from`` as a version."""
    rec, series = spark.read.parquet(f"{args.batch}/hourly_records"), tuple(args.series)
    versions = baseline_table(spark, args.versions, T.StructType([rec.schema[s] for s in series]))
    versions.add(baseline_version(rec, args.valid_from, series, args.rounding))
    return versions.read()


def _read_batch(spark: SparkSession, root: str, name: str, series: tuple[str, ...],
                fmt: str) -> DataFrame:
    fields = [T.StructField(s, T.StringType()) for s in series]
    schema = T.StructType(fields + list(RESULT_SCHEMAS[name].fields))
    return _read_input(spark, f"{root}/{name}", fmt, schema=schema)


def _plan(spark: SparkSession, args, stream: DataFrame, series, holidays, lateness: str, mode: str):
    """The plan of a job over the clean stream."""
    if args.job == "alerts":
        if args.versions:
            versions = baseline_table(spark, args.versions, T.StructType([stream.schema[s] for s in series]))
            return alerts_stream_asof(stream, versions.read, series, holidays, lateness, mode=mode, combine=args.combine)
        if not args.baseline:
            raise SystemExit("--baseline (the batch output folder) or --versions is needed for alerts")
        base = _read_batch(spark, args.baseline, "batch_hourly_baseline", series, args.format)
        if args.grain == "record":      # each record as it comes, like the hourly files it is made for
            return alerts_stream_records(record_stream(stream, series, holidays), base, series)
        return alerts_stream(stream, base, series, holidays, lateness, mode=mode, combine=args.combine)
    if args.job == "rolling":
        return rolling_stream(stream, series, args.hours, lateness, mode, args.combine)
    if args.job == "cumulative":
        return cumulative_stream(stream, series, holidays, lateness, mode, args.combine)
    return running_day_mean_stream(stream, series, lateness, mode, args.combine)


def _in_order(spark: SparkSession, args, source: FileInput, series, holidays, root: str) -> DataFrame:
    def make(raw: DataFrame, lateness: str):
        stream = _clean(raw, args)
        return _plan(spark, args, stream.drop("holiday_flag") if args.marker else stream, series, holidays,
                     lateness, "update")

    clock = to_wall_clock(args.time_col, source.schema[args.time_col].dataType, args.time_format)
    stats: dict = {}
    table = merged_table(spark, make(source.stream(spark), "0 seconds"), f"{root}/table") if args.merge else None
    out = replay_in_order(spark, source, clock, make, args.job, root, stats=stats,
                          state_partitions=args.state_partitions, table=table)
    print(f"{args.job}: {stats}")
    return out


def run_stream(spark: SparkSession, args):
    series = tuple(args.series)
    root = f"{args.out}/{args.job}"
    if args.versions:
        args.grain = "hour"     # an hour is compared with the version of its own time
    raw, _, schema = _read_raw(spark, args)
    source = FileInput(args.input, schema, args.input_format)
    batch = _clean(raw, args)
    stream = _clean(file_stream(spark, args.input, schema, fmt=args.input_format), args)
    if args.marker:
        batch, stream = batch.drop("holiday_flag"), stream.drop("holiday_flag")
    holidays = _marked(spark, args, root)
    if args.in_order:
        if args.every or args.mode == "append" or args.late == "store":
            raise SystemExit("--in-order replays in update mode and loses no row: not with --every, --mode append "
                             "or --late store")
        return _in_order(spark, args, source, series, holidays, root)
    lateness = args.lateness or ("1 hour" if args.every else replay_lateness(batch))
    finish = None
    # Hours are classified once closed; an open hour's class could change.
    mode = "append" if args.job == "alerts" and args.grain == "hour" else args.mode
    if mode == "append" and not args.every and not (args.job == "alerts" and args.grain == "record"):
        stream = with_end_marker(stream, f"{root}/end_marker")
        finish = lambda: end_marker(batch, f"{root}/end_marker", lateness)
    plan = _plan(spark, args, stream, series, holidays, lateness, mode)
    table = merged_table(spark, plan, f"{root}/table") if args.merge else None
    late = LateRows(source, args.time_col, f"try_cast({args.value} AS BIGINT) IS NOT NULL",
                    args.time_format) if args.late == "store" and plan.stateful else None
    partitions = args.state_partitions or default_state_partitions(spark)
    if not args.every:
        stats: dict = {}
        out = run_to_table(spark, plan, args.job, root, stats, partitions,
                           "fail" if args.late == "store" and late is None else args.late, finish,
                           table=table, late_rows=late)
        print(f"{args.job}: {stats}")
        return out
    query = start(plan, f"{root}/out", f"{root}/checkpoint", {"processingTime": args.every},
                  name=f"flowtally_{args.job}", state_partitions=partitions, table=table, late_rows=late)
    query.awaitTermination()
    print(f"{args.job}: {progress_stats(query)}")
    if table is not None:
        return table.read()
    return read_latest(spark, f"{root}/out", plan.keys, output_schema(spark, plan),
                       snapshot=latest_snapshot(spark, root))


def _read_stream(spark: SparkSession, root: str, job: str, series: tuple[str, ...]) -> DataFrame:
    return stream_result(spark, root, job, series)


def run_check(spark: SparkSession, args) -> dict[str, DataFrame]:
    series = tuple(args.series)
    base = _read_batch(spark, args.batch, "batch_hourly_baseline", series, args.format)
    davg = _read_batch(spark, args.batch, "batch_daily_average", series, args.format)
    total = _read_batch(spark, args.batch, "batch_daily_total", series, args.format)
    out = {"holiday_diff": holiday_diff(base, series)}
    alerts = _read_stream(spark, args.stream, "alerts", series)
    out.update({
        "alert_distribution": alert_distribution(alerts),
        "check_high": check_high(alerts, base, series),
        "check_low": check_low(alerts, base, series),
        "check_normal": check_normal(alerts, base, series),
        "check_endpoint": check_endpoint(total, _read_stream(spark, args.stream, "cumulative",
                                                             series), series),
        "endpoint_coverage": endpoint_coverage(total, _read_stream(spark, args.stream, "cumulative",
                                                                   series), series),
        "check_convergence": check_convergence(_read_stream(spark, args.stream, "rolling",
                                                            series), davg, series),
    })
    out["import_counts"] = import_counts({"batch_hourly_baseline": base,
                                          "batch_daily_average": davg,
                                          "batch_daily_total": total})
    for name, df in out.items():
        _write(df, f"{args.out}/{name}", args.format)
    return out


def run_compact(spark: SparkSession, args) -> int | None:
    """Freeze the committed batches of one stream job's result table."""
    root = f"{args.stream}/{args.job}"
    versions = spark.read.parquet(f"{root}/out")
    schema = T.StructType([f for f in versions.schema.fields if f.name != "batch_id"])
    upto = compact(spark, root, [*args.series, *STREAM_KEYS[args.job]], schema)
    print(f"compacted {args.job} up to batch {upto}" if upto is not None else "nothing to compact")
    return upto


def run_export(spark: SparkSession, args) -> list[str]:
    """Each named result table (all registered ones by default) as one
    headered CSV file below ``--out``; one file is one writing task."""
    names = register_result_views(spark, args.batch, args.stream, tuple(args.series), args.format)
    chosen = args.tables or names
    for name in chosen:
        export_csv(spark.table(name), f"{args.out}/{name}")
    return chosen


def run_sql(spark: SparkSession, args) -> list[DataFrame]:
    """Register the result tables as views, run each statement, show or
    write (``--out``: one folder per statement, ``q1``, ``q2``, ...)."""
    register_result_views(spark, args.batch, args.stream, tuple(args.series), args.format)
    results = [spark.sql(text) for text in args.statements]
    for i, df in enumerate(results, 1):
        if args.out:
            _write(df, f"{args.out}/q{i}", args.format)
        else:
            df.show(args.show, truncate=False)
            total = df.count()
            if total > args.show:
                print(f"{args.show} of {total} rows shown; --out writes them all")
    return results


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="flowtally")
    p.add_argument("--cluster", action="store_true",
                   help="apply the large-cluster settings of flowtally.session.CLUSTER_CONF")
    sub = p.add_subparsers(dest="cmd", required=True)

    def common(sp, needs_input=True):
        if needs_input:
            sp.add_argument("--input", required=True)
            sp.add_argument("--input-format", default="parquet")
            sp.add_argument("--time-col", required=True)
            sp.add_argument("--time-format", default="yyyy-MM-dd HH:mm:ss")
            sp.add_argument("--value", required=True, help="SQL expression of a record's traffic")
            sp.add_argument("--holidays", default="us_federal",
                            help="us_federal | none | comma-separated dates")
            sp.add_argument("--schema", help="the input's columns as a Spark DDL string")
            sp.add_argument("--marker", help="SQL condition of rows that mark their day as a holiday; "
                                             "goes before --holidays")
            sp.add_argument("--combine", default="sum", choices=["sum", "max"],
                            help="records of one hour: counts to add up, or readings that repeat")
        sp.add_argument("--series", nargs="*", default=[])
        sp.add_argument("--format", default="csv", choices=["csv", "parquet"])
        sp.add_argument("--out", required=True)

    b = sub.add_parser("batch")
    common(b)
    b.add_argument("--rounding", default=None, choices=["half_up", "floor"])
    b.add_argument("--state", help="folder of stored hour sums: only files that are new to it are read")
    v = sub.add_parser("publish", help="add a baseline version")
    v.add_argument("--batch", required=True)
    v.add_argument("--valid-from", required=True, help="yyyy-MM-dd HH:mm:ss")
    v.add_argument("--versions", required=True)
    v.add_argument("--series", nargs="*", default=[])
    v.add_argument("--rounding", default=None, choices=["half_up", "floor"])
    s = sub.add_parser("stream")
    common(s)
    s.add_argument("--job", required=True, choices=list(STREAM_TABLES))
    s.add_argument("--baseline")
    s.add_argument("--lateness", help="default: 1 hour with --every; in a replay the input's time span")
    s.add_argument("--late", default="fail", choices=["fail", "report", "store"],
                   help="a replay that loses late rows fails, reports them, or stores them whole")
    s.add_argument("--versions", help="folder of published baseline versions, for alerts on hours")
    s.add_argument("--merge", action="store_true", help="merge the result by key into a table of few files")
    s.add_argument("--in-order", action="store_true", help="replay files in the order of their times")
    s.add_argument("--grain", default="record", choices=["record", "hour"],
                   help="alerts on each record as it comes, or on each hour once it is closed")
    s.add_argument("--state-partitions", type=int, help="default: the session's cores at the start")
    s.add_argument("--hours", type=int, default=24)
    s.add_argument("--every", default=None, help="processing-time trigger, e.g. '1 minute'")
    s.add_argument("--mode", default="update", choices=["update", "append"],
                   help="update: early, revisable rows; append: each row once, when final")
    c = sub.add_parser("check")
    common(c, needs_input=False)
    c.add_argument("--batch", required=True)
    c.add_argument("--stream", required=True)
    k = sub.add_parser("compact", help="freeze a stream job's committed batches")
    k.add_argument("--stream", required=True)
    k.add_argument("--job", required=True, choices=list(STREAM_TABLES))
    k.add_argument("--series", nargs="*", default=[])
    x = sub.add_parser("export", help="result tables as single headered CSV files")
    x.add_argument("--batch")
    x.add_argument("--stream")
    x.add_argument("--series", nargs="*", default=[])
    x.add_argument("--format", default="csv", choices=["csv", "parquet"])
    x.add_argument("--tables", nargs="*", default=None)
    x.add_argument("--out", required=True)
    q = sub.add_parser("sql", help="run SQL over the result tables registered as views")
    q.add_argument("--batch")
    q.add_argument("--stream")
    q.add_argument("--series", nargs="*", default=[])
    q.add_argument("--format", default="csv", choices=["csv", "parquet"])
    q.add_argument("--out", default=None)
    q.add_argument("--show", type=int, default=50)
    q.add_argument("-e", "--execute", action="append", required=True, dest="statements",
                   help="a SQL statement (repeatable)")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    args = parser().parse_args(argv)
    spark = spark or build_session(master=None, shuffle_partitions=None, cluster=args.cluster)
    run = {"batch": run_batch, "stream": run_stream, "check": run_check,
           "compact": run_compact, "export": run_export, "sql": run_sql, "publish": run_publish}[args.cmd]
    return run(spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
