"""Late rows of a stream, kept whole.

Spark drops a row when the event-time window it belongs to ended at or before
the watermark of the micro-batch before, and counts only partial sums of what
it drops.  Here every micro-batch looks its own files up once more and stores
the rows whose (first) window had ended: the watermark and the files are those
that the query's checkpoint names for the batch, so that a batch replayed after
a failure stores the same rows over again.  Only files and row groups that hold
times before the watermark are read.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtally.functions.time import to_wall_clock
from flowtally.sources.stream import FileInput, list_names, path_kind

CLOSED = "closed_at"        # end of the row's (first) window
WATERMARK = "watermark"     # that the row was compared with


@dataclass
class LateRows:
    """Where late rows come from and go to.

    ``time`` is the raw time column of ``source``; ``counts`` the raw rows
    that cleaning keeps (others are rejected, not late).
    """

    source: FileInput
    time: str
    counts: Column | str | None = None
    time_format: str | None = None

    def of_batch(self, spark: SparkSession, checkpoint: str, batch_id: int,
                 closes: Callable[[Column], Column]) -> DataFrame | None:
        """The late rows of a micro-batch, raw columns and two more; None if
        there can be none."""
        watermark = batch_watermark(spark, checkpoint, batch_id - 1)
        paths = batch_files(spark, checkpoint, batch_id) if watermark > 0 else []
        if not paths:
            return None
        raw = self.source.rows(spark, paths)
        kind = raw.schema[self.time].dataType
        clock = to_wall_clock(self.time, kind, *([self.time_format] if self.time_format else []))
        bound = F.timestamp_millis(F.lit(watermark))
        if self.counts is not None:
            raw = raw.where(self.counts)
        if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):     # what the scan can use
            raw = raw.where(F.col(self.time) < bound.cast(kind))
        return (raw.withColumns({CLOSED: closes(clock), WATERMARK: bound})
                .where(F.col(CLOSED) <= F.col(WATERMARK)))

    def schema(self) -> T.StructType:
        return T.StructType([*self.source.schema.fields, T.StructField(CLOSED, T.TimestampType()),
                             T.StructField(WATERMARK, T.TimestampType())])


def _lines(spark: SparkSession, path: str) -> list[str]:
    return [r.value for r in spark.read.text(path).collect()]


def _offsets(spark: SparkSession, checkpoint: str, batch_id: int) -> tuple[dict, list[dict]]:
    """Metadata and source offsets that the checkpoint names for a batch."""
    if batch_id < 0 or str(batch_id) not in list_names(spark, f"{checkpoint}/offsets"):
        return {}, []
    lines = _lines(spark, f"{checkpoint}/offsets/{batch_id}")[1:]       # after the format's version
    return json.loads(lines[0]), [json.loads(x) if x.startswith("{") else {} for x in lines[1:]]


def batch_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark of a micro-batch in milliseconds; 0 before there is one."""
    return int(_offsets(spark, checkpoint, batch_id)[0].get("batchWatermarkMs", 0))


def batch_files(spark: SparkSession, checkpoint: str, batch_id: int, source: int = 0) -> list[str]:
    """The files that a micro-batch reads from the query's file source."""
    def upto(batch: int) -> int:
        offsets = _offsets(spark, checkpoint, batch)[1]
        return int(offsets[source].get("logOffset", -1)) if len(offsets) > source else -1

    first, last = upto(batch_id - 1) + 1, upto(batch_id)
    log = f"{checkpoint}/sources/{source}"
    names = set(list_names(spark, log))
    logs = {n for k in range(first, last + 1) for n in (str(k), f"{k}.compact") if n in names}
    if not logs:
        return []
    entry = F.from_json("value", "path string, batchId long")
    rows = (spark.read.text([f"{log}/{n}" for n in sorted(logs)]).where(F.col("value").startswith("{"))
            .select(entry.alias("e")).where(F.col("e.batchId").between(first, last)).select("e.path").distinct())
    return sorted(unquote(r.path) for r in rows.collect())      # the log keeps them as URLs


def store_late(spark: SparkSession, late: LateRows, closes: Callable[[Column], Column], checkpoint: str,
               folder: str, batch_id: int) -> None:
    """Write the late rows of a micro-batch to a folder of its own."""
    rows = late.of_batch(spark, checkpoint, batch_id, closes)
    if rows is not None:
        rows.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


def read_late(spark: SparkSession, folder: str, late: LateRows) -> DataFrame:
    """All stored late rows, with the ``batch_id`` they came in."""
    full = T.StructType([*late.schema().fields, T.StructField("batch_id", T.LongType())])
    if path_kind(spark, folder) is None:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(folder)
