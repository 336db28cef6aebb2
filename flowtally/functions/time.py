"""Time derivations (P2), all free of the session time zone.

Wall-clock values are kept as ``timestamp_ntz``.  The hour grain is an
integer *hour index* (hours since 1970-01-01 00:00 wall clock), so ordering,
range windows and day buckets are plain integer arithmetic and never depend
on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtally.fixed import DATETIME_FORMAT, HOURS_PER_DAY


def to_wall_clock(col: Column | str, data_type: T.DataType | None = None,
                  fmt: str = DATETIME_FORMAT) -> Column:
    """Any time-like column as ``timestamp_ntz`` (unparseable -> NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(data_type, T.TimestampNTZType):
        return c
    if isinstance(data_type, (T.TimestampType, T.DateType)):
        return c.cast("timestamp_ntz")
    text, pattern = c.cast("string"), F.lit(fmt)
    # to_timestamp_ntz parses the wall clock exactly (no session-zone detour,
    # so times inside a DST gap survive) but raises on bad text under ANSI;
    # try_to_timestamp only guards it, so bad text becomes NULL.
    return F.when(F.try_to_timestamp(text, pattern).isNotNull(),
                  F.to_timestamp_ntz(text, pattern))


def date_string(date_col: Column) -> Column:
    """A DateType column as ``yyyy-MM-dd`` (casting a date is zone free)."""
    return date_col.cast("string")


def hour_index(ts_ntz: Column) -> Column:
    """Hours since the epoch on the wall clock of a ``timestamp_ntz``."""
    return F.unix_date(F.to_date(ts_ntz)).cast("long") * HOURS_PER_DAY + F.hour(ts_ntz)


def hour_index_to_date(hidx: Column) -> Column:
    return F.date_from_unix_date(F.floor(hidx / HOURS_PER_DAY).cast("int"))


def hour_index_to_hour(hidx: Column) -> Column:
    return F.pmod(hidx, F.lit(HOURS_PER_DAY)).cast("int")


def hour_index_to_string(hidx: Column) -> Column:
    """``yyyy-MM-dd HH:00:00`` for an hour index."""
    return F.concat(
        date_string(hour_index_to_date(hidx)), F.lit(" "),
        F.lpad(hour_index_to_hour(hidx).cast("string"), 2, "0"), F.lit(":00:00"))


def event_time(ts_ntz: Column) -> Column:
    """The instant of a wall-clock value read as UTC, for watermarks.

    ``withWatermark`` needs a ``timestamp``; taking the wall clock as UTC keeps
    hour and day windows aligned with the wall-clock hours and dates.
    """
    return F.timestamp_seconds(F.unix_timestamp(ts_ntz))


def instant_hour_index(ts: Column) -> Column:
    """Hour index of an instant made by :func:`event_time` (e.g. window ends)."""
    return F.floor(F.unix_seconds(ts) / 3600).cast("long")
