"""Visits: runs of records of one vehicle without a long gap, and the counts built on them.

A key (station, vehicle) may hold a third of all records, so no task ever sorts the raw records of
a key. Records are first folded, map side, into time slices no wider than the gap. Two records of
one slice can never be further apart than the gap, so the first and last time of a slice are all
that is left to compare, and a key has at most (time span / gap) slices however many records it
has.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window, functions as F

from wayfold.operators.geo import PREC, TOL, scaled, snap_in_box
from wayfold.operators.spine import DAY, keyed_spine, trailing_range, whole_days, zero_fill
from wayfold.plans.timing import MICRO, as_datetime, as_delta, window_of
from wayfold.sources.readers import scan_range

# A visit ends after this gap; an hourly visit needs this spacing.
VISIT_GAP = timedelta(minutes=15)
MIN_SPACING = timedelta(minutes=2)
HOUR = timedelta(hours=1)


def _slices(df: DataFrame, keys: Sequence[str], ts: str, gap: str | timedelta) -> DataFrame:
    """One row per (key, slice) with its first and last time, and whether it opens a visit."""
    gap = as_delta(gap)
    folded = (
        df.withColumn("__slice", window_of(ts, max(gap, MICRO))["start"])
        .groupBy(*keys, "__slice")
        .agg(F.min(ts).alias("__first"), F.max(ts).alias("__last"), F.count("*").alias("__n"))
    )
    before = F.lag("__last").over(Window.partitionBy(*keys).orderBy("__slice"))
    opens = before.isNull() | ((F.col("__first") - before) > F.lit(gap))
    return folded.withColumn("__opens", opens.cast("int"))


def visits(
    df: DataFrame, keys: Sequence[str], ts: str = "dateTime", gap: str | timedelta = VISIT_GAP
) -> DataFrame:
    """One row per visit: key, ``visit_start``, ``visit_end`` and number of ``records``.

    A new visit begins where the time since the record before is longer than ``gap``.
    """
    so_far = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, 0)
    return (
        _slices(df, keys, ts, gap)
        .withColumn("__visit", F.sum("__opens").over(so_far))
        .groupBy(*keys, "__visit")
        .agg(
            F.min("__first").alias("visit_start"),
            F.max("__last").alias("visit_end"),
            F.sum("__n").alias("records"),
        )
        .drop("__visit")
    )


def visit_counts(
    df: DataFrame, by: Sequence[str], each: Sequence[str], ts: str = "dateTime",
    gap: str | timedelta = VISIT_GAP,
) -> DataFrame:
    """Visits per ``by``, counted apart for every value of ``each`` (the vehicle)."""
    return _slices(df, [*by, *each], ts, gap).groupBy(*by).agg(F.sum("__opens").alias("visits"))


def _hits(
    snap: DataFrame, routes: DataFrame, start: datetime, end: datetime, width: timedelta,
    station: int | None, prec: int, tol: float,
) -> DataFrame:
    """Start-box records of a range with the ``startTime`` of their window."""
    key = () if station is None else ("station_id", station)
    rows = scan_range(snap, "dateTime", start, end, *key)
    rows = rows.select("station_id", "vehicle_id", "dateTime", "lat", "lon")
    return snap_in_box(rows, routes, "start", prec, tol).withColumn(
        "startTime", window_of("dateTime", width, start)["start"]
    )


def _stations(routes: DataFrame, station: int | None) -> DataFrame:
    ids = routes.select("station_id")
    return ids if station is None else ids.where(F.col("station_id") == F.lit(station))


def daily_frequency(
    snap: DataFrame, routes: DataFrame, start: str | datetime, end: str | datetime,
    gap: str | timedelta = VISIT_GAP, prec: int = PREC, tol: float = TOL,
    station: int | None = None, scale: bool = True, keep_empty: bool = False, partial: bool = False,
) -> DataFrame:
    """Visits in the start box per route and day, divided by the loop factor.

    The range must be whole days; ``partial`` also counts a cut last one. ``keep_empty`` adds a zero row for each route and day without visits.
    """
    start, end = whole_days(start, end, partial)
    hits = _hits(snap, routes, start, end, DAY, station, prec, tol)
    counts = visit_counts(hits, ["station_id", "factor", "startTime"], ["vehicle_id"], "dateTime", gap)
    freq = scaled(F.col("visits"), F.col("factor")) if scale else F.col("visits")
    result = counts.select("station_id", "startTime", freq.alias("freq"))
    if not keep_empty:
        return result
    spine = keyed_spine(_stations(routes, station), start, end, DAY)
    return zero_fill(result, spine, ["station_id", "startTime"], ["freq"])


def weekly_frequency(
    snap: DataFrame, routes: DataFrame, end: str | datetime, days: int = 7,
    station: int | None = None, scale: bool = True, **box: object,
) -> DataFrame:
    """Daily frequency of the whole days up to ``end``, zero where there was no visit."""
    first, last = trailing_range(end, days)
    return daily_frequency(
        snap, routes, first, last, station=station, scale=scale, keep_empty=True, **box
    )


def hourly_records(
    snap: DataFrame, routes: DataFrame, start: str | datetime, end: str | datetime,
    width: str | timedelta = HOUR, station: int | None = None, prec: int = PREC, tol: float = TOL,
) -> DataFrame:
    """Records in the start box per route and window counted from ``start``."""
    start, end, width = as_datetime(start), as_datetime(end), as_delta(width)
    hits = _hits(snap, routes, start, end, width, station, prec, tol)
    counts = hits.groupBy("station_id", "startTime").agg(F.count("*").alias("freq"))
    spine = keyed_spine(_stations(routes, station), start, end, width)
    return zero_fill(counts, spine, ["station_id", "startTime"], ["freq"])


def hourly_visits(
    snap: DataFrame, routes: DataFrame, start: str | datetime, end: str | datetime,
    width: str | timedelta = HOUR, min_space: str | timedelta = MIN_SPACING,
    station: int | None = None, count_first: bool = True, prec: int = PREC, tol: float = TOL,
) -> DataFrame:
    """Visits per window with a minimum spacing; ``count_first=False`` leaves out the first one."""
    start, end, width = as_datetime(start), as_datetime(end), as_delta(width)
    hits = _hits(snap, routes, start, end, width, station, prec, tol)
    counts = visit_counts(hits, ["station_id", "startTime"], ["vehicle_id"], "dateTime", min_space)
    freq = F.col("visits") if count_first else F.col("visits") - F.lit(1)
    counts = counts.select("station_id", "startTime", freq.cast("bigint").alias("freq"))
    spine = keyed_spine(_stations(routes, station), start, end, width)
    return zero_fill(counts, spine, ["station_id", "startTime"], ["freq"])
