"""Batch sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtally.schemas import CLEAN_SCHEMA, RESULT_SCHEMAS, conform

CORRUPT = "_corrupt_record"


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType,
                 header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Raw CSV with a declared schema; returns (good rows, bad rows).

    Malformed lines are kept in ``_corrupt_record`` (PERMISSIVE mode) and
    split off instead of failing the job or vanishing silently.  ``bad`` keeps
    every column; write it to a quarantine table rather than ``count()`` it
    alone (Spark refuses scans that read only the corrupt-record column).
    """
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    raw = (spark.read.schema(full).option("header", header).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    good = raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = raw.where(F.col(CORRUPT).isNotNull())
    return good, bad


def read_clean(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The clean hourly table (date_time, date, hour, is_holiday, traffic)."""
    reader = spark.read.schema(CLEAN_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def read_result_parts(spark: SparkSession, path: str, table: str,
                      series: T.StructType | None = None) -> DataFrame:
    """S3: the CSV part files of a batch result, with the declared schema."""
    fields = list(series.fields) if series is not None else []
    schema = T.StructType(fields + list(RESULT_SCHEMAS[table].fields))
    return spark.read.schema(schema).option("header", True).csv(path)


def read_result_jdbc(spark: SparkSession, url: str, table: str,
                     properties: dict | None = None, result_table: str | None = None,
                     series: tuple[str, ...] = ()) -> DataFrame:
    """One of the six result tables from a relational store, conformed to
    the declared schema of ``result_table`` (default: the same name).

    ``properties`` may carry Spark's JDBC read options, e.g. ``partitionColumn``
    / ``lowerBound`` / ``upperBound`` / ``numPartitions`` for a parallel read.
    """
    df = spark.read.jdbc(url, table, properties=properties or {})
    return conform(df, result_table or table, series)


def read_result_table(spark: SparkSession, name: str, table: str,
                      series: tuple[str, ...] = ()) -> DataFrame:
    """One of the six result tables from the session catalog (a table or
    view named ``name``), conformed to its declared schema."""
    return conform(spark.table(name), table, series)
