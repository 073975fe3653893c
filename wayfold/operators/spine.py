"""Interval spines, anchored windows and zero filling."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayfold.plans.timing import (
    as_datetime, as_delta, interval_count, ntz_literal, window_of,
)

DAY = timedelta(days=1)


def full_intervals(
    spark: SparkSession, start: str | datetime, end: str | datetime, step: str | timedelta = DAY,
    partial: bool = False,
) -> DataFrame:
    """Start of every complete interval inside [start, end]; ``partial`` keeps a cut last one."""
    count = interval_count(start, end, step, partial)
    return spark.range(count).select(_nth_start(start, step, F.col("id")).alias("startTime"))


def _nth_start(start: str | datetime, step: str | timedelta, n: Column) -> Column:
    return ntz_literal(start) + F.lit(as_delta(step)) * n


def keyed_spine(
    dim: DataFrame, start: str | datetime, end: str | datetime, step: str | timedelta,
    partial: bool = True,
) -> DataFrame:
    """Every row of ``dim`` once per interval."""
    count = interval_count(start, end, step, partial)
    if count == 0:
        return dim.withColumn("startTime", ntz_literal(start)).where(F.lit(False))
    numbered = dim.withColumn("__n", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    return numbered.withColumn("startTime", _nth_start(start, step, F.col("__n"))).drop("__n")


def whole_days(start: str | datetime, end: str | datetime, partial: bool = False) -> tuple[datetime, datetime]:
    """The range, if it is one of whole days; ``partial`` allows a cut last one."""
    start, end = as_datetime(start), as_datetime(end)
    if not partial and end > start and (end - start) % DAY:
        raise ValueError("the range must be whole days, or partial=True counts a cut last one")
    return start, end


def previous_day(now: str | datetime) -> tuple[datetime, datetime]:
    """The calendar day before ``now`` as a half-open range."""
    today = as_datetime(now).replace(hour=0, minute=0, second=0, microsecond=0)
    return today - DAY, today


def previous_day_of(ts: Column) -> Column:
    """Column form: midnight that begins the day before ``ts``."""
    return F.date_sub(ts.cast("date"), 1).cast("timestamp_ntz")


def trailing_range(end: str | datetime, days: int = 7) -> tuple[datetime, datetime]:
    """Range of the whole days, aligned to midnight, that end no later than ``end``."""
    end = as_datetime(end)
    first = (end - days * DAY).replace(hour=0, minute=0, second=0, microsecond=0)
    return first, first + ((end - first) // DAY) * DAY


def trailing_days(spark: SparkSession, end: str | datetime, days: int = 7) -> DataFrame:
    return full_intervals(spark, *trailing_range(end, days))


def clamp_range(
    start: str | datetime, end: str | datetime, longest: str | timedelta = DAY
) -> tuple[datetime, datetime]:
    """The range, cut to at most ``longest``."""
    start, end = as_datetime(start), as_datetime(end)
    return start, min(end, start + as_delta(longest))


def clamp_end(start: Column, end: Column, longest: str | timedelta = DAY) -> Column:
    """Column form of :func:`clamp_range`: the new end."""
    return F.least(end, start + F.lit(as_delta(longest)))


def anchored_window(
    df: DataFrame, ts: str, start: str | datetime, end: str | datetime, width: str | timedelta
) -> DataFrame:
    """Add ``startTime`` and ``endTime`` of the window counted from ``start``, cut at ``end``."""
    window = "__window"
    return (
        df.withColumn(window, window_of(ts, width, start))
        .withColumn("startTime", F.col(window)["start"])
        .withColumn("endTime", F.least(F.col(window)["end"], ntz_literal(end)))
        .drop(window)
    )


def zero_fill(
    agg: DataFrame, spine: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Every spine row, with 0 where ``agg`` (one row per key) has none."""
    filled = spine.join(agg.select(*keys, *values), list(keys), "left")
    return filled.withColumns({v: F.coalesce(F.col(v), F.lit(0).cast(agg.schema[v].dataType)) for v in values})


def missing_days(
    fact: DataFrame, start: str | datetime, end: str | datetime, ts: str = "startTime"
) -> DataFrame:
    """Days of [start, end] without any fact; what a backfill still has to run."""
    done = fact.select(window_of(ts, DAY)["start"].alias("startTime")).distinct()
    return full_intervals(fact.sparkSession, start, end).join(done, "startTime", "left_anti")
