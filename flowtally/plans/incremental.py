"""Incremental batch results (A1-A3): new files are added once, and only once.

The state is a keyed table of hour sums, one row per (series, day, hour): the
smallest grain from which all three results follow, and one that can be added
up.  An arrival reads the files that the table's ledger lacks, adds them up by
hour and commits sums and ledger in one step, so an arrival that is killed, or
repeated, changes nothing.  Results are worked out from the state, which is
smaller than the input by the records of an hour; the input is never read again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtally.operators.aggregates import daily_average, daily_total, hourly_baseline
from flowtally.operators.prepare import hour_records, hour_sums
from flowtally.sinks.keyed import DELTAS, KeyedTable

FILE = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
                     T.StructField("changed", T.TimestampType())])
NEW_FILES = 100_000     # file names that one arrival passes to the reader


def hour_state(spark: SparkSession, root: str, series: T.StructType, combine: str = "sum",
               marked: bool = False, deltas: int = DELTAS) -> KeyedTable:
    """The table of hour sums at ``root``, its ranges the months.  ``marked``:
    the records carry a holiday marker of their own."""
    fields = [*series.fields, T.StructField("day", T.DateType()), T.StructField("hour", T.IntegerType()),
              T.StructField("traffic", T.LongType()), T.StructField("n_records", T.LongType())]
    rule = {"traffic": combine, "n_records": "sum"}
    if marked:
        fields.append(T.StructField("holiday_flag", T.IntegerType()))
        rule["holiday_flag"] = "max"
    return KeyedTable(spark, root, T.StructType(fields), [*series.names, "day", "hour"],
                      "date_format(day, 'yyyy-MM')", rule, deltas)


def files_of(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """path, length and time of change of the files below ``path``; their
    content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", F.col("modificationTime").alias("changed"))


def arrive(state: KeyedTable, path: str, read: Callable[[Sequence[str]], DataFrame],
           series: Sequence[str] = (), combine: str = "sum", glob: str | None = "*.parquet",
           most: int = NEW_FILES) -> int:
    """Add the files below ``path`` that the state does not hold; returns how
    many there were.

    ``read`` turns file names into clean records.  More than ``most`` new files
    are added by several commits.  A file that was added and has changed since
    fails the call: what it held before cannot be told from the sums.
    """
    spark, added = state.spark, 0
    while True:
        known = state.ledger(FILE).select(F.col("path").alias("_path"), F.col("length").alias("_length"),
                                          F.col("changed").alias("_changed"))
        seen = files_of(spark, path, glob).join(known, F.col("path") == F.col("_path"), "left")
        changed = seen.where("_path IS NOT NULL AND (length <> _length OR changed <> _changed)")
        first = changed.select("path").first()
        if first is not None:
            raise RuntimeError(f"{first.path} has changed since it was added")
        new = seen.where("_path IS NULL").select(*FILE.names).orderBy("path").limit(most).collect()
        if not new:
            return added
        sums = hour_sums(read([r.path for r in new]), series, combine)
        state.add(sums, ledger=spark.createDataFrame(new, FILE).coalesce(1))
        added += len(new)
        if len(new) < most:
            return added


def hour_table(state: KeyedTable, series: Sequence[str] = (), holidays="us_federal") -> DataFrame:
    """The hourly records that the state stands for."""
    return hour_records(state.read(), series, holidays)


def results(state: KeyedTable, series: Sequence[str] = (), holidays="us_federal",
            rounding: str | None = None) -> dict[str, DataFrame]:
    """The three batch result tables from the state."""
    rec = hour_table(state, series, holidays)
    return {"batch_hourly_baseline": hourly_baseline(rec, series, rounding),
            "batch_daily_average": daily_average(rec, series), "batch_daily_total": daily_total(rec, series)}
