"""Trips: runs of records with one direction, their travel times, and first arrivals."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from wayfold.functions.time import hour_slot
from wayfold.operators.geo import PREC, TOL, snap_in_box
from wayfold.operators.spine import DAY, keyed_spine, whole_days, zero_fill
from wayfold.plans.joins import join_dim
from wayfold.plans.ranking import top_per_group
from wayfold.plans.timing import (
    EPOCH, as_datetime, as_delta, micros_between, window_of,
)
from wayfold.sources.readers import scan_range

# A trip must last longer than this many minutes; sampled ids per interval.
MIN_MINUTES = 8
IDS_PER_INTERVAL = 3
KEYS = ("station_id", "vehicle_id")

# Width of the time slices that spread one key over many tasks.
SLICE = timedelta(minutes=1)


def direction_runs(
    snap: DataFrame, keys: Sequence[str] = KEYS, ts: str = "dateTime", tag: str = "dirTag",
    tie: str = "event_id", restart: str | timedelta | None = None,
    anchor: str | datetime = EPOCH, slice_width: str | timedelta = SLICE,
) -> DataFrame:
    """One row per run of records with equal direction: key, ``tag``, ``run_start``, ``run_end``,
    ``records``. With ``restart`` runs are also cut at intervals counted from ``anchor``.

    Runs are found inside time slices of a key first, so that a key with a third of all records is
    spread over many tasks. Only the first and last run of a slice can go on in a neighbour slice;
    the others are final and not shuffled again. At most two runs per slice and key are stitched in time order.
    """
    keys = list(keys)
    rows = snap.select(*keys, F.col(ts).alias("__t"), F.col(tag).alias("__tag"), F.col(tie).alias("__tie"))
    if restart is not None:
        rows = rows.withColumn("__part", window_of("__t", restart, anchor)["start"])
        keys.append("__part")
    rows = rows.withColumn("__slice", window_of("__t", slice_width)["start"])

    in_slice = Window.partitionBy(*keys, "__slice")
    ordered = in_slice.orderBy("__t", "__tie")
    changed = (F.row_number().over(ordered) > 1) & ~F.col("__tag").eqNullSafe(F.lag("__tag").over(ordered))
    runs = (
        rows.withColumn("__changed", changed.cast("int"))
        .withColumn("__run", F.sum("__changed").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "__slice", "__run", "__tag")
        .agg(F.min("__t").alias("__start"), F.max("__t").alias("__end"), F.count("*").alias("__n"))
    )
    at_edge = (F.col("__run") == 0) | (F.col("__run") == F.max("__run").over(in_slice))
    runs = runs.withColumn("__edge", at_edge)
    own = [k for k in keys if k != "__part"]
    final = runs.where("NOT __edge").select(
        *own, F.col("__tag").alias("tag"), F.col("__start").alias("run_start"), F.col("__end").alias("run_end"),
        F.col("__n").alias("records"),
    )

    in_time = Window.partitionBy(*keys).orderBy("__slice", "__run")
    opens = (
        (F.col("__run") > 0)
        | (F.row_number().over(in_time) == 1)
        | ~F.col("__tag").eqNullSafe(F.lag("__tag").over(in_time))
    )
    stitched = (
        runs.where("__edge")
        .withColumn("__opens", opens.cast("int"))
        .withColumn("__id", F.sum("__opens").over(in_time.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "__id", F.col("__tag").alias("tag"))
        .agg(
            F.min("__start").alias("run_start"), F.max("__end").alias("run_end"),
            F.sum("__n").alias("records"),
        )
        .select(*own, "tag", "run_start", "run_end", "records")
    )
    return final.unionAll(stitched)


def long_runs(runs: DataFrame, min_minutes: float = MIN_MINUTES) -> DataFrame:
    """Runs that last strictly longer than the minimum: the trips."""
    return runs.where((F.col("run_end") - F.col("run_start")) > F.lit(timedelta(minutes=min_minutes)))


def trips(snap: DataFrame, min_minutes: float = MIN_MINUTES, **runs: object) -> DataFrame:
    """Trips with their ``duration_us``."""
    kept = long_runs(direction_runs(snap, **runs), min_minutes)
    return kept.withColumn("duration_us", micros_between(F.col("run_start"), F.col("run_end")))


def merge_avg(
    partials: DataFrame, keys: Sequence[str], total: str, count: str
) -> DataFrame:
    """Mean per key from partial (sum, count) rows, divided only at the end."""
    merged = partials.groupBy(*keys).agg(F.sum(total).alias(total), F.sum(count).alias(count))
    return merged.withColumn("average", F.col(total) / F.col(count))


def _mean_minutes(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    sums = runs.groupBy(*keys).agg(F.sum("duration_us").alias("us"), F.count("*").alias("trips"))
    return sums.select(*keys, "trips", (F.col("us") / (F.col("trips") * F.lit(60e6))).alias("minutes"))


def _rounded(value: Column, decimals: int) -> Column:
    step = F.lit(float(10**decimals))
    return F.floor(value * step + F.lit(0.5)) / step


def travel_by_bucket(
    snap: DataFrame, start: str | datetime, end: str | datetime, width_h: int = 4,
    station: int | None = None, ids: DataFrame | None = None, min_minutes: float = MIN_MINUTES,
    cut_days: bool = True, partial: bool = False,
) -> DataFrame:
    """Mean trip minutes per route and slot of ``width_h`` hours. The range must be whole days;
    ``partial`` also takes a cut last one.

    A trip over the end of a day is cut there, so days can be run apart; ``cut_days=False`` keeps
    it whole, in the slot of its start.
    """
    start, end = whole_days(start, end, partial)
    rows = _rows(snap, start, end, station, ids)
    found = trips(rows, min_minutes, restart=DAY if cut_days else None, anchor=start)
    found = found.withColumn("startTime", hour_slot(F.col("run_start"), width_h))
    means = _mean_minutes(found, ["station_id", "startTime"])
    return means.select("station_id", "startTime", _rounded(F.col("minutes"), 1).alias("travelTime"))


def travel_by_hour(
    snap: DataFrame, stations: DataFrame, start: str | datetime, end: str | datetime,
    station: int | None = None, ids: DataFrame | None = None, min_minutes: float = MIN_MINUTES,
) -> DataFrame:
    """Mean trip minutes, whole, per route and hour counted from ``start``; 0 for empty hours."""
    hour = timedelta(hours=1)
    rows = _rows(snap, as_datetime(start), as_datetime(end), station, ids)
    found = trips(rows, min_minutes)
    found = found.withColumn("startTime", window_of("run_start", hour, start)["start"])
    means = _mean_minutes(found, ["station_id", "startTime"]).select(
        "station_id", "startTime", _rounded(F.col("minutes"), 0).cast("bigint").alias("travelTime")
    )
    names = stations.select("station_id")
    if station is not None:
        names = names.where(F.col("station_id") == F.lit(station))
    spine = keyed_spine(names, start, end, hour)
    return zero_fill(means, spine, ["station_id", "startTime"], ["travelTime"])


def _rows(
    snap: DataFrame, start: datetime, end: datetime, station: int | None, ids: DataFrame | None
) -> DataFrame:
    key = () if station is None else ("station_id", station)
    rows = scan_range(snap, "dateTime", start, end, *key)
    rows = rows.select(*KEYS, "dateTime", "dirTag", "event_id")
    return rows if ids is None else keep_ids(rows, ids)


def keep_ids(snap: DataFrame, ids: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Records of the sampled ids."""
    return join_dim(snap, ids.select(*keys).distinct(), keys, "left_semi")


def _ids_per_interval(
    snap: DataFrame, start: str | datetime, end: str | datetime, width: str | timedelta, n: int,
    order: Sequence[Column],
) -> DataFrame:
    """The first ``n`` distinct vehicles per station and interval in the given order."""
    rows = scan_range(snap, "dateTime", start, end).select(
        "station_id", window_of("dateTime", width, start)["start"].alias("startTime"), "vehicle_id"
    )
    return top_per_group(rows.distinct(), ["station_id", "startTime"], order, n)


def first_ids(
    snap: DataFrame, start: str | datetime, end: str | datetime,
    width: str | timedelta = timedelta(hours=4), n: int = IDS_PER_INTERVAL,
) -> DataFrame:
    """The lowest ``n`` vehicle ids of each station and interval."""
    return _ids_per_interval(snap, start, end, width, n, [F.col("vehicle_id")])


def sample_ids(
    snap: DataFrame, start: str | datetime, end: str | datetime,
    width: str | timedelta = timedelta(hours=1), n: int = IDS_PER_INTERVAL, seed: str = "ids",
) -> DataFrame:
    """Up to ``n`` vehicle ids of each station and interval in a reproducible random order."""
    shuffled = F.md5(F.concat(F.lit(seed), F.col("vehicle_id").cast("string")))
    return _ids_per_interval(snap, start, end, width, n, [shuffled, F.col("vehicle_id")])


def first_arrival(
    snap: DataFrame, routes: DataFrame, start: str | datetime, end: str | datetime,
    width: str | timedelta = timedelta(hours=4), min_minutes: float = MIN_MINUTES,
    prec: int = PREC, tol: float = TOL,
) -> DataFrame:
    """Per station and interval: the first record in the start box, and the first later record of
    the same vehicle in the end box that is more than the minimum away."""
    start = as_datetime(start)
    rows = scan_range(snap, "dateTime", start, end).select(*KEYS, "dateTime", "lat", "lon", "event_id")
    rows = rows.withColumn("startTime", window_of("dateTime", as_delta(width), start)["start"])
    first = F.min(F.struct("dateTime", "event_id", "vehicle_id"))
    departures = (
        snap_in_box(rows, routes, "start", prec, tol)
        .groupBy("station_id", "startTime")
        .agg(first.alias("__first"))
        .select(
            "station_id", "startTime", F.col("__first.vehicle_id").alias("vehicle_id"),
            F.col("__first.dateTime").alias("departed"),
        )
    )
    arrivals = snap_in_box(rows, routes, "end", prec, tol).select(*KEYS, "startTime", "dateTime")
    wait = F.col("dateTime") - F.col("departed")
    return (
        join_dim(arrivals, departures, ["station_id", "startTime", "vehicle_id"])
        .where(wait > F.lit(timedelta(minutes=min_minutes)))
        .groupBy("station_id", "startTime", "vehicle_id", "departed")
        .agg(F.min("dateTime").alias("arrived"))
        .withColumn("travel_us", micros_between(F.col("departed"), F.col("arrived")))
    )
