"""Time helpers that never depend on the session time zone."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F, types as T

EPOCH = datetime(1970, 1, 1)
MICRO = timedelta(microseconds=1)

_UNITS = {
    "microsecond": MICRO,
    "millisecond": timedelta(milliseconds=1),
    "second": timedelta(seconds=1),
    "minute": timedelta(minutes=1),
    "hour": timedelta(hours=1),
    "day": timedelta(days=1),
    "week": timedelta(weeks=1),
}


def as_delta(width: str | timedelta) -> timedelta:
    """``"15 minutes"`` or a timedelta, as a timedelta."""
    if isinstance(width, timedelta):
        return width
    number, unit = width.split()
    return int(number) * _UNITS[unit.lower().rstrip("s")]


def as_datetime(value: str | datetime) -> datetime:
    return value if isinstance(value, datetime) else datetime.fromisoformat(value)


def _interval_text(width: timedelta) -> str:
    return f"{width // MICRO} microseconds"


def ts_literal(df: DataFrame, column: str, value: str | datetime) -> Column:
    """A literal of the column's own timestamp type, so that comparisons reach the file scan."""
    text = as_datetime(value).isoformat(sep=" ")
    return F.lit(text).cast(df.schema[column].dataType)


def ntz_literal(value: str | datetime) -> Column:
    return F.lit(as_datetime(value).isoformat(sep=" ")).cast(T.TimestampNTZType())


def window_of(ts: Column | str, width: str | timedelta, start: str | datetime = EPOCH) -> Column:
    """Tumbling window (struct of start and end) counted from ``start``."""
    width = as_delta(width)
    offset = (as_datetime(start) - EPOCH) % width
    return F.window(ts, _interval_text(width), _interval_text(width), _interval_text(offset))


def micros_between(start: Column, end: Column) -> Column:
    seconds = (end - start).cast("interval second").cast("decimal(18,6)")
    return (seconds * 1_000_000).cast("bigint")


def interval_count(
    start: str | datetime, end: str | datetime, step: str | timedelta, partial: bool = False
) -> int:
    """How many steps fit in [start, end); ``partial`` also counts a cut last one."""
    span, step = as_datetime(end) - as_datetime(start), as_delta(step)
    whole, rest = divmod(span, step)
    return max(0, whole + (1 if partial and rest else 0))
