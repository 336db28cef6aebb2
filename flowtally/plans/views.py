"""The six result tables as temp views, for checks written in SQL.

``register_result_views`` reads the stored batch results and the stream
result tables back -- each stream key resolved to its newest version -- and
registers them under the declared table names with their declared schemas,
so that verification SQL runs through ``spark.sql`` unchanged in its table
and column names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from flowtally.schemas import RESULT_SCHEMAS, conform
from flowtally.sinks.keyed import stored_table
from flowtally.streaming.sink import latest_snapshot, read_latest

BATCH_VIEWS = ("batch_hourly_baseline", "batch_daily_average", "batch_daily_total")
# stream job folder -> key columns besides the series
STREAM_KEYS = {"alerts": ["date_time"], "rolling": ["current_time"],
               "cumulative": ["date", "hour"], "day_mean": ["current_time"]}
# stream job folder -> declared table it is registered as
STREAM_VIEWS = {"alerts": "flink_alert_result", "rolling": "flink_rolling_avg_result",
                "cumulative": "flink_cumulative_result"}


def _exists(spark: SparkSession, path: str) -> bool:
    from flowtally.sources.stream import path_kind
    return path_kind(spark, path) is not None


def _batch(spark: SparkSession, root: str, name: str, series: Sequence[str],
           fmt: str) -> DataFrame:
    fields = [T.StructField(s, T.StringType()) for s in series]
    reader = spark.read.schema(T.StructType(fields + list(RESULT_SCHEMAS[name].fields)))
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(f"{root}/{name}")


def stream_result(spark: SparkSession, root: str, job: str, series: Sequence[str]) -> DataFrame:
    """A stream job's stored result, one row per key (newest version)."""
    if _exists(spark, f"{root}/{job}/table"):
        return stored_table(spark, f"{root}/{job}/table", [*series, *STREAM_KEYS[job]]).read()
    path = f"{root}/{job}/out"
    versions = spark.read.parquet(path)
    schema = T.StructType([f for f in versions.schema.fields if f.name != "batch_id"])
    return read_latest(spark, path, [*series, *STREAM_KEYS[job]], schema,
                       snapshot=latest_snapshot(spark, f"{root}/{job}"))


def register_result_views(spark: SparkSession, batch_dir: str | None = None,
                          stream_dir: str | None = None, series: Sequence[str] = (),
                          fmt: str = "csv") -> list[str]:
    """Register every result table found below the two folders; returns the
    names registered."""
    names = []
    if batch_dir:
        for name in BATCH_VIEWS:
            if _exists(spark, f"{batch_dir}/{name}"):
                _batch(spark, batch_dir, name, series, fmt).createOrReplaceTempView(name)
                names.append(name)
    if stream_dir:
        for job, name in STREAM_VIEWS.items():
            if _exists(spark, f"{stream_dir}/{job}/out") or _exists(spark, f"{stream_dir}/{job}/table"):
                df = conform(stream_result(spark, stream_dir, job, series), name, tuple(series))
                df.createOrReplaceTempView(name)
                names.append(name)
    return names
