"""Idempotent stream sink (K3), last-write-wins read, and compaction.

Each micro-batch is written to its own folder ``batch_id=<n>`` with
overwrite, so a batch replayed after a failure replaces its own output and
changes nothing else.  Readers resolve every key to the row of its highest
batch id -- an aggregation on the key, map-side partial, no driver step.

A long-running stream leaves one folder per micro-batch.  :func:`compact`
freezes the resolved rows of all *committed* batches (a committed batch is
never replayed) into ``snapshot/upto=<n>``; readers then take that snapshot
plus only the batch folders after ``n``, and the partition filter on
``batch_id`` keeps the older folders from being read at all.  Nothing is
deleted, so compaction never races the running stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtally.sources.stream import list_names, path_kind

BATCH_COL = "batch_id"
SNAPSHOT_DIR = "snapshot"


def batch_writer(out_path: str, per_batch=None):
    def write(batch_df: DataFrame, batch_id: int) -> None:
        df = per_batch(batch_df) if per_batch is not None else batch_df
        df.write.mode("overwrite").parquet(f"{out_path}/{BATCH_COL}={batch_id}")
    return write


def latest_snapshot(spark: SparkSession, root: str) -> tuple[str, int] | None:
    """The newest complete snapshot below ``root`` as (path, upto), if any."""
    done = []
    for name in list_names(spark, f"{root}/{SNAPSHOT_DIR}"):
        if name.startswith("upto="):
            path = f"{root}/{SNAPSHOT_DIR}/{name}"
            if "_SUCCESS" in list_names(spark, path):
                done.append((int(name.split("=", 1)[1]), path))
    if not done:
        return None
    upto, path = max(done)
    return path, upto


def last_committed(spark: SparkSession, checkpoint: str) -> int | None:
    """Highest micro-batch id in the checkpoint's commit log."""
    ids = [int(n) for n in list_names(spark, f"{checkpoint}/commits") if n.isdigit()]
    return max(ids) if ids else None


def read_latest(spark: SparkSession, out_path: str, keys: Sequence[str],
                schema: T.StructType, snapshot: tuple[str, int] | None = None,
                upto: int | None = None) -> DataFrame:
    """One row per key: its version from the highest batch id.

    ``snapshot`` = (path, n) replaces all batches up to ``n``; ``upto`` leaves
    out batches after it.  A stream that has written nothing yet reads as
    empty; any other failure to read is raised.
    """
    full = T.StructType(list(schema.fields) + [T.StructField(BATCH_COL, T.LongType())])
    if path_kind(spark, out_path) is None:
        versions = spark.createDataFrame([], full)
    else:
        versions = spark.read.schema(full).parquet(out_path)
    if snapshot is not None:
        snap_path, snap_upto = snapshot
        versions = versions.where(F.col(BATCH_COL) > snap_upto).unionByName(
            spark.read.schema(schema).parquet(snap_path)
            .withColumn(BATCH_COL, F.lit(snap_upto).cast("long")))
    if upto is not None:
        versions = versions.where(F.col(BATCH_COL) <= upto)
    others = [c for c in schema.names if c not in keys]
    if not others:
        return versions.select(*keys).distinct()
    # One max_by per column of a batch's row: a key has one row in a batch, so
    # all columns come from the same row.
    return (versions.groupBy(*keys)
            .agg(*[F.max_by(F.col(c), F.col(BATCH_COL)).alias(c) for c in others])
            .select(*schema.names))


def compact(spark: SparkSession, root: str, keys: Sequence[str],
            schema: T.StructType) -> int | None:
    """Freeze the committed batches of the stream stored below ``root``
    (``root/out``, ``root/checkpoint``) into ``root/snapshot/upto=<n>``;
    returns ``n`` (None when nothing is committed or nothing is new)."""
    last = last_committed(spark, f"{root}/checkpoint")
    prior = latest_snapshot(spark, root)
    if last is None or (prior is not None and prior[1] >= last):
        return None
    current = read_latest(spark, f"{root}/out", keys, schema, snapshot=prior, upto=last)
    current.write.mode("overwrite").parquet(f"{root}/{SNAPSHOT_DIR}/upto={last}")
    return last
