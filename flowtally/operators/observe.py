"""Counts of what an intake reads, rejects and keeps, taken in the same pass.

``Dataset.observe`` adds the counts to the plan: they are there when the job
that reads the rows ends (batch) or with each micro-batch's progress (stream),
without another scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtally.fixed import DATETIME_FORMAT
from flowtally.functions.time import to_wall_clock

INTAKE = "intake"
METRICS = T.StructType([
    T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType()),
    T.StructField("name", T.StringType()), T.StructField("metric", T.StringType()),
    T.StructField("value", T.LongType())])


def observed(raw: DataFrame, time_col: str, value: Column | str, name: str | Observation = INTAKE,
             corrupt: str | None = None, time_format: str = DATETIME_FORMAT) -> DataFrame:
    """``raw`` as it is, with the counts that :func:`~flowtally.operators.prepare.clean`
    and ``rejected`` imply: ``rows_read``, ``malformed`` (rows with text in the
    ``corrupt`` column), ``rejected_time``, ``rejected_value`` and ``kept``.

    ``name`` is a text for streams, an ``Observation`` in a batch.
    """
    value_col = F.col(value) if isinstance(value, str) else value
    bad = F.col(corrupt).isNotNull() if corrupt else F.lit(False)
    no_time = to_wall_clock(time_col, raw.schema[time_col].dataType, time_format).isNull()
    no_value = value_col.try_cast("long").isNull()
    return raw.observe(
        name, F.count(F.lit(1)).alias("rows_read"), F.count_if(bad).alias("malformed"),
        F.count_if(~bad & no_time).alias("rejected_time"),
        F.count_if(~bad & ~no_time & no_value).alias("rejected_value"),
        F.count_if(~bad & ~no_time & ~no_value).alias("kept"))


def batch_metrics(spark: SparkSession, observation: Observation, run: str, name: str = INTAKE) -> DataFrame:
    """The counts of a finished batch job, one row each."""
    return spark.createDataFrame([(run, None, name, k, v) for k, v in observation.get.items()], METRICS)


def progress_metrics(spark: SparkSession, reports: Iterable, run: str) -> DataFrame:
    """The counts in a stream's progress reports, one row per batch and count;
    rows that state operators dropped as late (partial sums) among them."""
    rows = {}
    for p in reports:
        for name, counts in (p.get("observedMetrics") or {}).items():
            counts = counts.asDict() if isinstance(counts, T.Row) else dict(counts)
            rows.update({(run, p["batchId"], name, k): int(v) for k, v in counts.items()})
        dropped = sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators", []))
        rows[(run, p["batchId"], "state", "dropped_late_groups")] = dropped
    return spark.createDataFrame([(*k, v) for k, v in rows.items()], METRICS)
