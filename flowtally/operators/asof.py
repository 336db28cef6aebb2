"""Alerts against a baseline that is renewed (J5, L1): as-of lookup.

A baseline version holds from its ``valid_from`` on, until a later version of
the same key.  A record is compared with the version that held at its own time,
so batch, stream and any replay give it the same alert, whenever it comes and
whatever was published since.  The version is noted in the alert.

A key's versions become one list, sorted by time: as many entries as renewals,
not as records.  Records meet the lists in one equi-join on (series,
is_holiday, hour), as with a single baseline.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtally.fixed import HIGH_RATIO, LOW_RATIO
from flowtally.functions.classify import alert_status
from flowtally.operators.aggregates import hourly_baseline
from flowtally.operators.joins import join_on
from flowtally.sinks.keyed import KeyedTable

VALID_FROM = "valid_from"       # yyyy-MM-dd HH:mm:ss, compared as text like date_time


def baseline_version(rec: DataFrame, valid_from: str, series: Sequence[str] = (),
                     rounding: str | None = None) -> DataFrame:
    """The baseline of the hourly records before ``valid_from``, as the
    version that holds from then on."""
    known = rec.where(F.col("date_time") < valid_from)
    return hourly_baseline(known, series, rounding).withColumn(VALID_FROM, F.lit(valid_from))


def baseline_table(spark: SparkSession, root: str, series: T.StructType) -> KeyedTable:
    """Published versions: a table merged by key, its ranges the months.  A
    version that is published again replaces itself."""
    schema = T.StructType([*series.fields, T.StructField("is_holiday", T.IntegerType()),
                           T.StructField("hour", T.IntegerType()), T.StructField("avg_traffic", T.DoubleType()),
                           T.StructField(VALID_FROM, T.StringType())])
    return KeyedTable(spark, root, schema, [*series.names, "is_holiday", "hour", VALID_FROM],
                      f"substring({VALID_FROM}, 1, 7)")


def version_lists(versions: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """One row per (series, is_holiday, hour): its versions sorted by time.
    Two values for one key and time fail the job."""
    keys = [*series, "is_holiday", "hour"]
    once = F.when(F.count(F.lit(1)) == 1, F.max("avg_traffic")).otherwise(
        F.raise_error(F.lit("two baselines of a key hold from the same time")).cast("double"))
    single = versions.groupBy(*keys, VALID_FROM).agg(once.alias("avg_traffic"))
    return single.groupBy(*keys).agg(F.sort_array(F.collect_list(
        F.struct(VALID_FROM, "avg_traffic"))).alias("versions"))


def join_version(rec: DataFrame, versions: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Records with ``baseline`` and ``baseline_version`` of their time; a
    record before its key's first version drops out, as without a baseline."""
    joined = join_on(rec, version_lists(versions, series), [*series, "is_holiday", "hour"])
    # The record's time stands in the list itself: a lambda that reads it from the row lets the
    # optimizer move the filter below to the lists' side, where there is no such time.
    timed = F.arrays_zip(F.col("versions").alias("v"), F.array_repeat("date_time", F.size("versions")).alias("at"))
    held = F.filter(timed, lambda x: x["v"][VALID_FROM] <= x["at"])
    return (joined.withColumn("_held", F.try_element_at(held, F.lit(-1))["v"])
            .where(F.col("_held").isNotNull())
            .withColumns({"baseline": F.col("_held.avg_traffic"),
                          "baseline_version": F.col(f"_held.{VALID_FROM}")}).drop("_held", "versions"))


def alerts_asof(rec: DataFrame, versions: DataFrame, series: Sequence[str] = (),
                high: float = HIGH_RATIO, low: float = LOW_RATIO) -> DataFrame:
    """L3 with renewed baselines: the alert columns and ``baseline_version``."""
    return join_version(rec, versions, series).select(
        *series, "date_time", "traffic", "baseline", "is_holiday", "hour",
        alert_status(F.col("traffic"), F.col("baseline"), high, low).alias("alert_status"), "baseline_version")
