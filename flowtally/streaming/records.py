"""W3 at every record in a stream: the trailing mean of each record, emitted
once its hour is closed.

The query's state holds one row per (series, open hour).  When the watermark
closes hours, their records and those of the window before are read from the
source files that the query has seen, by time, and the batch operator
(:func:`~flowtally.operators.windows.rolling_records`) works on these.  So a
series' records are never gathered in one state, and results are those of the
batch over all records that were in time: a record that came after its hour was
closed counts nowhere.

What is read again is the closed hours and one window before them: little when
a micro-batch closes a day or more, and about 25 hours when it closes one hour.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtally.fixed import ROLLING_HOURS
from flowtally.functions.time import hour_index_to_string, instant_hour_index, to_wall_clock
from flowtally.operators.joins import join_on
from flowtally.operators.windows import records_by_hour
from flowtally.session import scratch_path
from flowtally.sources.stream import FileInput, path_kind
from flowtally.streaming.jobs import end_marker, hour_end, with_end_marker, with_event_time
from flowtally.streaming.late import batch_files, batch_watermark
from flowtally.streaming.runner import default_state_partitions, progress_stats, refuse_loss

SEEN = T.StructType([T.StructField("path", T.StringType()), T.StructField("watermark", T.LongType())])


def closed_hours(clean_stream: DataFrame, series: Sequence[str], lateness: str) -> DataFrame:
    """(*series, _hour) of the hours with records, once each is closed."""
    return (with_event_time(clean_stream, lateness).groupBy(F.window("evt", "1 hour"), *series)
            .agg(F.count(F.lit(1)).alias("_n"))
            .select(*series, instant_hour_index(F.col("window.start")).alias("_hour")))


def _in_time(spark: SparkSession, source: FileInput, seen: DataFrame, time_col: str, lo: int, hi: int) -> DataFrame:
    """The raw rows of hours ``lo`` to ``hi`` that were in time, from the
    files seen: one row for each file reaches the driver, as for any read."""
    paths = sorted({r.path for r in seen.select("path").collect()})
    raw = source.rows(spark, paths)
    kind = raw.schema[time_col].dataType
    first, after = (hour_index_to_string(F.lit(h).cast("long")) for h in (lo, hi + 1))
    clock = to_wall_clock(time_col, kind)
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):     # what the scan can use
        raw = raw.where((F.col(time_col) >= first.cast(kind)) & (F.col(time_col) < after.cast(kind)))
    else:
        raw = raw.where((clock >= first.cast("timestamp_ntz")) & (clock < after.cast("timestamp_ntz")))
    def local(path):        # a local file is file:/x in one place and file:///x in another
        return F.regexp_replace(path, "^file:/+", "file:/")

    of_file = seen.select(local(F.col("path")).alias("_path"), F.col("watermark").alias("_watermark"))
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    named = raw.withColumn("_file", local(plain)).join(of_file, F.col("_file") == F.col("_path"))
    return (named.where(hour_end(clock) > F.timestamp_millis("_watermark"))
            .drop("_file", "_path", "_watermark"))


def replay_records(spark: SparkSession, source: FileInput, time_col: str, cleaned: Callable[[DataFrame], DataFrame],
                   series: Sequence[str] = (), hours: int = ROLLING_HOURS, lateness: str = "1 hour",
                   name: str = "rolling_records", root: str | None = None, max_files_per_trigger: int | None = None,
                   late: str = "fail", stats: dict | None = None) -> DataFrame:
    """Replay ``source`` to its end into the columns of ``rolling_records``.

    ``cleaned`` turns raw rows, streaming or not, into clean records
    ``(*series, ts, traffic)``.  Rows that come too late fail the replay unless
    ``late="report"``.  Results of a micro-batch are written to a folder of
    their own, over again if it is replayed.
    """
    root = root or scratch_path(spark, name)
    everything = cleaned(source.rows(spark))
    stream = with_end_marker(cleaned(source.stream(spark, max_files_per_trigger)), f"{root}/end_marker")
    empty = records_by_hour(everything.limit(0), series, hours).drop("_hour")

    def write(closed: DataFrame, batch_id: int) -> None:
        session = closed.sparkSession
        before = max(batch_watermark(session, f"{root}/checkpoint", batch_id - 1), 0)
        mine = [(p, before) for p in batch_files(session, f"{root}/checkpoint", batch_id)]
        session.createDataFrame(mine, SEEN).coalesce(1).write.mode("overwrite").parquet(f"{root}/seen/batch_id={batch_id}")
        closed.write.mode("overwrite").parquet(f"{root}/closed/batch_id={batch_id}")
        hours_closed = session.read.schema(closed.schema).parquet(f"{root}/closed/batch_id={batch_id}")
        lo, hi = hours_closed.agg(F.min("_hour"), F.max("_hour")).first()
        if lo is None:
            return
        seen = session.read.schema(SEEN).parquet(f"{root}/seen")
        records = cleaned(_in_time(session, source, seen, time_col, lo - hours, hi))
        found = join_on(records_by_hour(records, series, hours), hours_closed, [*series, "_hour"], "left_semi")
        found.drop("_hour").write.mode("overwrite").parquet(f"{root}/out/batch_id={batch_id}")

    total: dict = {"dropped_late_groups": 0, "complete": True}
    for step in (None, lambda: end_marker(everything, f"{root}/end_marker", lateness)):
        if step is not None:
            step()
        settings = {"spark.sql.shuffle.partitions": str(default_state_partitions(spark) or 8)}
        held = {k: spark.conf.get(k, None) for k in settings}
        for k, v in settings.items():
            spark.conf.set(k, v)
        try:
            query = (closed_hours(stream, series, lateness).writeStream.outputMode("append").foreachBatch(write)
                     .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
        finally:
            for k, v in held.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(f"stream {name} failed: {query.exception()}")
        found = progress_stats(query)
        total["dropped_late_groups"] += found["dropped_late_groups"]
        total["complete"] &= found["complete"]
    if stats is not None:
        stats.update(total)
    if late == "fail":
        refuse_loss(name, total)
    if path_kind(spark, f"{root}/out") is None:
        return empty
    return spark.read.schema(empty.schema).parquet(f"{root}/out").drop("batch_id")
