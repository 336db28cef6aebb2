"""V6 while the streams run: each closed day's total against its curve's end.

Both sides are streams: the records, added up by day, and the rows of the
cumulative curve, of which the day's last hour counts.  They meet in a full
outer join on (series, day) once the day is closed on both, so a day that one
side lost comes out as well, once, after the watermark has passed it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.functions.time import date_string
from flowtally.streaming.jobs import DEFAULT_LATENESS, StreamPlan, with_event_time

BOTH, TOTAL_ONLY, CURVE_ONLY = "both", "total only", "curve only"


def endpoint_stream(records: DataFrame, curve: DataFrame, series: Sequence[str] = (),
                    lateness: str = DEFAULT_LATENESS) -> StreamPlan:
    """V6 on closed days, append mode.

    ``records``: clean stream ``(*series, ts, traffic)``; ``curve``: stream of
    ``(*series, ts, cumulative_traffic)`` with ``ts`` the hour of the row.
    Result ``(*series, date, batch_total, stream_final, diff, sides)``; ``diff``
    is null where a side lacks the day, which ``sides`` tells.
    """
    day = F.window("evt", "1 day").alias("_window")
    # No filter here: it would move below the watermark and hide an end marker's time from it.
    totals = (with_event_time(records, lateness).groupBy(day, *series)
              .agg(F.sum("traffic").alias("batch_total")))
    ends = (with_event_time(curve, lateness).groupBy(day, *series)
            .agg(F.max_by("cumulative_traffic", "ts").alias("stream_final")))
    ends = ends.select(F.col("_window").alias("_end_window"), *[F.col(c).alias(f"_end_{c}") for c in series],
                       "stream_final")
    same = totals["_window"] == ends["_end_window"]
    for c in series:
        same = same & totals[c].eqNullSafe(ends[f"_end_{c}"])
    joined = totals.join(ends, same, "full_outer")
    start = F.coalesce("_window.start", "_end_window.start")
    # A null series is one on both sides: which side holds the day tells whose it is.
    here = F.col("_window").isNotNull()
    frame = joined.select(
        *[F.when(here, F.col(c)).otherwise(F.col(f"_end_{c}")).alias(c) for c in series],
        date_string(F.to_date(start)).alias("date"), "batch_total", "stream_final",
        (F.col("batch_total") - F.col("stream_final")).alias("diff"),
        F.when(F.col("_end_window").isNull(), TOTAL_ONLY).when(F.col("_window").isNull(), CURVE_ONLY)
        .otherwise(BOTH).alias("sides"))
    return StreamPlan(frame, [*series, "date"], "append")
