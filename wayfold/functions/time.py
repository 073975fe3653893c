"""Time texts and buckets."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, functions as F

from wayfold.plans.timing import as_delta


def parse_ts(text: Column, strict: bool = False) -> Column:
    """Text to timestamp without zone; text in another form gives null, or an error if strict."""
    shaped = text.rlike(r"\A\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z")
    if strict:
        fault = F.raise_error(F.concat(F.lit("not a time: "), text)).cast("timestamp_ntz")
        return F.when(shaped, text.cast("timestamp_ntz")).when(text.isNotNull(), fault)
    return F.when(shaped, text.try_cast("timestamp_ntz"))


def interval_label(start: Column, width: str | timedelta) -> Column:
    """``"HH:MM - HH:MM"``."""
    end = start + F.lit(as_delta(width))
    return F.concat_ws(" - ", *[F.substring(t.cast("string"), 12, 5) for t in (start, end)])


def time_text(ts: Column) -> Column:
    """``"yyyy-MM-dd HH:mm:ss"``, cut to whole seconds."""
    return F.substring(ts.cast("string"), 1, 19)


def hour_bucket(ts: Column, hours: int = 4) -> Column:
    """First hour of the bucket of day."""
    return (F.floor(F.hour(ts) / F.lit(hours)) * F.lit(hours)).cast("int")


def hour_slot(ts: Column, hours: int) -> Column:
    """Start of the slot of ``hours`` clock hours that holds ``ts``; slots restart at midnight."""
    return ts.cast("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour_bucket(ts, hours))


def hour_start(ts: Column) -> Column:
    """The full hour at or before ``ts``."""
    return hour_slot(ts, 1)


def padded_hour(ts: Column) -> Column:
    return F.lpad(F.hour(ts).cast("string"), 2, "0")
