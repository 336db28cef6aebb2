"""Replaying a folder of files in time order, with state bounded by how far
the files overlap.

A replay whose files come in any order needs a lateness as wide as the data to
lose nothing, and then keeps every window's state to its end.  Here each file's
first and last time are looked up (one pass over the time column), files are
sorted by them and streamed in waves, one micro-batch each, from one
checkpoint.  The lateness is the largest step back in time from any earlier
wave to a later one: zero for files that follow each other, the span of the
data for files that all cover it.  Windows behind it are evicted wave by wave,
so state rows stay near the overlap and two waves.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtally.functions.time import to_wall_clock
from flowtally.session import scratch_path
from flowtally.sinks.keyed import KeyedTable
from flowtally.sources.stream import FileInput
from flowtally.streaming.jobs import StreamPlan
from flowtally.streaming.runner import (add_stats, default_state_partitions, output_schema, progress_stats,
                                        refuse_loss, start, state_rows)
from flowtally.streaming.sink import read_latest

FILES_PER_WAVE = 64


@dataclass
class Wave:
    files: list[str]
    first: float        # seconds
    last: float


def file_spans(spark: SparkSession, source: FileInput, time: Column | str) -> list[tuple[str, float, float]]:
    """(file, first, last time in seconds) of the files that hold a time, in
    the order of their times.  One row for each file reaches the driver."""
    rows = source.rows(spark)
    clock = time if isinstance(time, Column) else to_wall_clock(time, rows.schema[time].dataType)
    seconds = F.unix_timestamp(clock)
    spans = (rows.select(F.col("_metadata.file_path").alias("path"), seconds.alias("at"))
             .groupBy("path").agg(F.min("at").alias("first"), F.max("at").alias("last"))
             .where("first IS NOT NULL").collect())
    return sorted(((unquote(r.path), float(r["first"]), float(r["last"])) for r in spans), key=lambda x: (x[1], x[2], x[0]))


def waves(spans: list[tuple[str, float, float]], files_per_wave: int = FILES_PER_WAVE) -> list[Wave]:
    """Files in time order, ``files_per_wave`` at a time."""
    out = []
    for i in range(0, len(spans), files_per_wave):
        part = spans[i:i + files_per_wave]
        out.append(Wave([p for p, _, _ in part], min(a for _, a, _ in part), max(b for _, _, b in part)))
    return out


def overlap_lateness(in_order: list[Wave]) -> str:
    """The lateness under which no wave holds a late row."""
    latest, back = -math.inf, 0.0
    for wave in in_order:
        back = max(back, latest - wave.first)
        latest = max(latest, wave.last)
    return f"{math.ceil(back)} seconds" if back > 0 else "0 seconds"


def _only(paths: list[str]) -> str:
    """A glob that matches the names of ``paths``."""
    names = [p.rsplit("/", 1)[1] for p in paths]
    return "{" + ",".join(re.sub(r"([\\{}\[\]*?,])", r"\\\1", n) for n in names) + "}"


def replay_in_order(spark: SparkSession, source: FileInput, time: Column | str,
                    make: Callable[[DataFrame, str], StreamPlan], name: str, root: str | None = None,
                    files_per_wave: int = FILES_PER_WAVE, stats: dict | None = None,
                    state_partitions: int | None = None, table: KeyedTable | None = None) -> DataFrame:
    """Replay ``source`` in time order into the stored result, one row per
    key (merged into ``table`` where that is given).

    ``make`` turns the raw stream and a lateness into the plan, in update
    mode.  Files of one folder are told apart by name.  Rows that would be
    dropped fail the replay.  ``stats`` gets the figures of
    :func:`~flowtally.streaming.runner.progress_stats`, the number of waves,
    the lateness in seconds, and the most state rows after a wave.
    """
    spans = file_spans(spark, source, time)
    names = [p.rsplit("/", 1)[1] for p, _, _ in spans]
    if len(set(names)) < len(names):
        raise ValueError("files of equal name in different folders cannot be replayed in order")
    in_order = waves(spans, files_per_wave)
    lateness = overlap_lateness(in_order)
    root = root or scratch_path(spark, name)
    total, most_state = {"dropped_late_groups": 0, "complete": True}, 0
    plan = make(source.stream(spark), lateness)
    if plan.mode != "update":
        raise ValueError("a replay in order runs in update mode")
    for wave in in_order:
        plan = make(source.stream(spark, glob=_only(wave.files)), lateness)
        query = start(plan, f"{root}/out", f"{root}/checkpoint", table=table,
                      state_partitions=state_partitions or default_state_partitions(spark))
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(f"stream {name} failed: {query.exception()}")
        add_stats(total, progress_stats(query))
        most_state = max(most_state, state_rows(query))
        refuse_loss(name, total)
    if stats is not None:
        stats.update(total, waves=len(in_order), lateness_seconds=int(lateness.split()[0]), state_rows=most_state)
    if table is not None:
        return table.read()
    return read_latest(spark, f"{root}/out", plan.keys, output_schema(spark, plan))
