"""Running a :class:`StreamPlan` to a stored, last-write-wins table."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from flowtally.operators.observe import progress_metrics
from flowtally.session import scratch_path
from flowtally.sinks.keyed import KeyedTable, keyed_writer
from flowtally.streaming.jobs import StreamPlan
from flowtally.streaming.late import LateRows, store_late
from flowtally.streaming.sink import batch_writer, latest_snapshot, read_latest

_STARTING = threading.Lock()


def output_schema(spark: SparkSession, plan: StreamPlan):
    if plan.per_batch is None:
        return plan.frame.schema
    empty = spark.createDataFrame([], plan.frame.schema)
    return plan.per_batch(empty).schema


PROGRESS_KEPT = 100_000     # progress reports of one run that are kept to be added up


def default_state_partitions(spark: SparkSession) -> int | None:
    """One state partition per core that the session has now.  The number is
    frozen in the checkpoint: with dynamic allocation or for a query meant to
    grow, pass ``state_partitions`` instead."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except (AttributeError, PySparkException):      # no context: Spark Connect
        return None


def start(plan: StreamPlan, out_path: str, checkpoint: str, trigger: dict | None = None,
          name: str | None = None, state_partitions: int | None = None,
          table: KeyedTable | None = None, late_rows: LateRows | None = None):
    """Start the plan with the idempotent per-batch sink, or with ``table``
    with the sink that merges by key.  With ``late_rows`` the rows that come
    too late are stored whole beside it (``late`` next to ``out_path``).

    ``state_partitions`` sets the number of state-store partitions of a new
    query.  Spark takes it from ``spark.sql.shuffle.partitions`` when the
    query starts (the query runs on a clone of the session) and keeps it in
    the checkpoint for good, so the session's value is set only around
    ``start()`` and restored right after; a resumed query keeps its own.
    The same holds for skipping empty micro-batches in update mode.
    """
    write = keyed_writer(table, plan.per_batch) if table is not None else batch_writer(out_path, plan.per_batch)
    if late_rows is not None:
        write = _with_late(write, plan, late_rows, checkpoint, late_folder(out_path))
    writer = (plan.frame.writeStream.outputMode(plan.mode)
              .foreachBatch(write)
              .option("checkpointLocation", checkpoint)
              .trigger(**(trigger or {"availableNow": True})))
    if name:
        writer = writer.queryName(name)
    settings = {"spark.sql.streaming.numRecentProgressUpdates": str(PROGRESS_KEPT)}
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    if plan.mode == "update":
        # An empty micro-batch emits nothing in update mode (it only evicts
        # state, which the next data batch does as well).  Append mode keeps
        # them: they flush closed windows when no new data arrives.
        settings["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    spark = plan.frame.sparkSession
    with _STARTING:     # settings are the session's: one query starts at a time
        before = {k: spark.conf.get(k, None) for k in settings}
        for k, v in settings.items():
            spark.conf.set(k, v)
        try:
            return writer.start()
        finally:
            for k, v in before.items():
                if v is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, v)


def merged_table(spark: SparkSession, plan: StreamPlan, root: str) -> KeyedTable:
    """A table that a plan's result is merged into by key, its ranges the
    months of the key's date or time."""
    at = next(k for k in plan.keys if k in ("date", "date_time", "current_time"))
    return KeyedTable(spark, root, output_schema(spark, plan), plan.keys, f"substring(`{at}`, 1, 7)")


def late_folder(out_path: str) -> str:
    return f"{out_path.rsplit('/', 1)[0]}/late"


def _with_late(write, plan: StreamPlan, late_rows: LateRows, checkpoint: str, folder: str):
    if plan.closes is None:
        raise ValueError("the plan does not say when a row's window ends: it drops no row as late")

    def both(batch_df: DataFrame, batch_id: int) -> None:
        store_late(batch_df.sparkSession, late_rows, plan.closes, checkpoint, folder, batch_id)
        write(batch_df, batch_id)
    return both


def progress_stats(query) -> dict:
    """Batches, input rows and groups dropped as late, over the whole run.

    Spark counts what its state operators drop: rows already summed up per
    group and task, so ``dropped_late_groups`` is 0 exactly when no input row
    was lost, and otherwise lower than the number of input rows lost.  Of a
    run of more than ``PROGRESS_KEPT`` micro-batches the last are counted and
    ``complete`` is False.
    """
    reports = query.recentProgress
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in reports for op in p.get("stateOperators", []))
    return {"batches": len({p["batchId"] for p in reports}),
            "input_rows": sum(p.get("numInputRows", 0) for p in reports),
            "dropped_late_groups": dropped, "complete": len(reports) < PROGRESS_KEPT}


def state_rows(query) -> int:
    """The largest number of state rows that a micro-batch left."""
    return max((sum(op.get("numRowsTotal", 0) for op in p.get("stateOperators", []))
                for p in query.recentProgress), default=0)


def add_stats(total: dict, stats: dict) -> None:
    """Put the figures of one more run into those of the runs before."""
    for k, v in stats.items():
        total[k] = (total.get(k, True) and v) if k == "complete" else total.get(k, 0) + v


def refuse_loss(name: str, total: dict) -> None:
    """Fail if a run dropped rows, or was too long to know."""
    if total["dropped_late_groups"]:
        raise RuntimeError(f"stream {name}: rows came later than the watermark allows "
                           f"({total['dropped_late_groups']} groups of them were dropped)")
    if not total["complete"]:
        raise RuntimeError(f"stream {name}: more than {PROGRESS_KEPT} micro-batches in one run, the first reports "
                           "are gone: whether rows were dropped is not known")


def run_to_table(spark: SparkSession, plan: StreamPlan, name: str,
                 root: str | None = None, stats: dict | None = None,
                 state_partitions: int | None = None, late: str = "fail",
                 finish: Callable[[], None] | None = None, table: KeyedTable | None = None,
                 late_rows: LateRows | None = None, metrics: str | None = None) -> DataFrame:
    """Replay everything available (``availableNow``), then return the stored
    result with one row per key.  Checkpoint and table live below the shared
    checkpoint folder, so a rerun with the same ``root`` resumes.

    A replay that loses rows to the watermark fails, and so does one of too
    many micro-batches to know (``PROGRESS_KEPT``), unless ``late="report"``;
    ``late="store"`` keeps them whole, as ``late_rows`` says
    (:func:`~flowtally.streaming.late.read_late` of ``<root>/late``).  With
    ``table`` the result is merged into it by key.
    ``stats``, when given, is filled with :func:`progress_stats`; counts that
    the plan observes (:mod:`flowtally.operators.observe`) are added to the
    table at ``metrics``, by run and batch.  In append
    mode the windows still open at the end of the data are emitted after
    ``finish`` has moved the watermark (:func:`~flowtally.streaming.jobs.end_marker`);
    without it a stateful plan in append mode is refused, as its result would
    lack them.
    """
    if plan.mode == "append" and plan.stateful and finish is None:
        raise ValueError("append mode leaves the last windows of a bounded replay open: "
                         "pass finish, or use update mode")
    if (late == "store") != (late_rows is not None):
        raise ValueError('late="store" and late_rows go together')
    root = root or scratch_path(spark, name)
    total: dict = {}
    for step in (None, finish) if finish else (None,):
        if step is not None:
            step()
        query = start(plan, f"{root}/out", f"{root}/checkpoint",
                      state_partitions=state_partitions or default_state_partitions(spark),
                      table=table, late_rows=late_rows)
        query.awaitTermination()
        err = query.exception()
        if err is not None:
            raise RuntimeError(f"stream {name} failed: {err}")
        add_stats(total, progress_stats(query))
        if metrics is not None:
            (progress_metrics(spark, query.recentProgress, str(query.runId)).coalesce(1)
             .write.mode("append").parquet(metrics))
    if stats is not None:
        stats.update(total)
    if late == "fail":
        refuse_loss(name, total)
    if table is not None:
        return table.read()
    return read_latest(spark, f"{root}/out", plan.keys, output_schema(spark, plan),
                       snapshot=latest_snapshot(spark, root))
