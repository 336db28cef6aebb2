"""The driver's test tables mapped onto flow records.

* ``events``: ``ts`` is the record time, ``event_type`` the series and the
  traffic of a record is ``round(value * 100)`` (whole cents, so that every
  sum is an exact integer).
* ``orders``: one record per order on ``o_orderdate``, series
  ``o_orderstatus``, traffic ``round(o_totalprice * 100)``.
* ``lineitem``: one record per line on ``l_shipdate``, series
  ``l_returnflag``, traffic ``round(l_extendedprice * 100)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtally.operators.prepare import clean, hourly, records
from flowtally.sources.stream import file_stream

SERIES = ("series",)

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_clean(events: DataFrame) -> DataFrame:
    """Works on a batch or a streaming ``events`` frame alike."""
    return clean(events, "ts", F.round(F.col("value") * 100), {"series": "event_type"})


def event_hourly(spark: SparkSession, sf_dir: str, holidays="us_federal") -> DataFrame:
    return hourly(events_clean(table(spark, sf_dir, "events")), SERIES, holidays)


def event_stream(spark: SparkSession, sf_dir: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """``events`` replayed as a file stream: the table's part files when it
    is a folder, else the single ``events.parquet`` file of ``sf_dir``."""
    return file_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet", EVENTS_SCHEMA,
                       max_files_per_trigger=max_files_per_trigger)


def order_records(spark: SparkSession, sf_dir: str, holidays="us_federal") -> DataFrame:
    df = clean(table(spark, sf_dir, "orders"), "o_orderdate",
               F.round(F.col("o_totalprice") * 100), {"series": "o_orderstatus"})
    return records(df, SERIES, holidays)


def lineitem_records(spark: SparkSession, sf_dir: str, holidays="us_federal") -> DataFrame:
    df = clean(table(spark, sf_dir, "lineitem"), "l_shipdate",
               F.round(F.col("l_extendedprice") * 100), {"series": "l_returnflag"})
    return records(df, SERIES, holidays)
