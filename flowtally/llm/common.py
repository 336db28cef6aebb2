"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtally.session import scratch_path

WORD_PATTERN = r"[^\x20\x09-\x0D]+"


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def code_on_workers(spark: SparkSession) -> None:
    """Let Python workers that see this folder import the package from it,
    wherever the driver was started (a cluster ships it with --py-files)."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def whole_texts(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of ``rows`` rows where the session has Spark's default of
    10,000: rows that hold whole documents fill buffers of many times their
    size otherwise, on both sides of every Python worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(rows))


_KEPT: dict[str, dict] = {}


def kept(operator: str) -> dict:
    """What a Python worker keeps from one task of ``operator`` to the next.
    What it kept for another operator goes: workers outlive the stages of a
    pipeline, and their memories would add up."""
    if operator not in _KEPT:
        _KEPT.clear()
        give_back()
        _KEPT[operator] = {}
    return _KEPT[operator]


def give_back() -> None:
    """Hand freed memory back to the system, where the C library can: a
    worker that lives on holds it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    code_on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and reread: a
    cut in the lineage that survives the loss of executors."""
    code_on_workers(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def protected(docs: DataFrame) -> DataFrame:
    """``docs`` with columns renamed whose names begin with an underscore, as
    the operators' own do: ``toDF(*docs.columns)`` gives them back."""
    taken = {c.lower() for c in docs.columns}
    names = []
    for i, name in enumerate(docs.columns):
        fresh = f"kept {i}" if name.startswith("_") else name
        while fresh != name and fresh in taken:
            fresh += " "
        names.append(fresh)
    return docs.toDF(*names)


def numbered(rows: DataFrame, times: str, name: str, most: int = 10_000) -> DataFrame:
    """``rows``, each as often as its ``times`` says, with ``name`` running
    from 0; a row that repeats more than ``most`` times is given out by several
    tasks."""
    long = F.col(times).cast("long")
    few = rows.filter(F.col(times) <= most).withColumn(
        name, F.explode(F.sequence(F.lit(0).cast("long"), long - 1)))
    parts = rows.filter(F.col(times) > most).withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("long"), long - 1, F.lit(most).cast("long"))))
    many = (parts.repartition(*rows.columns, "_from")
            .withColumn(name, F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + most, long) - 1)))
            .drop("_from"))
    return few.unionByName(many)


def share_hash(*cols, buckets: int = 1_000_000, seed: int = 17):
    """A stable number from 0 to ``buckets - 1`` for a row's key."""
    return F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(buckets))
