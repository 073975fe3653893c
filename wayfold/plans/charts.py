"""The six chart queries and the route list, each one lazy DataFrame of ordered JSON rows."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from wayfold.functions.time import interval_label, time_text
from wayfold.operators.density import dense_areas
from wayfold.operators.rollup import frequency_top, route_list, travel_top
from wayfold.operators.sampling import path_sample
from wayfold.operators.trips import travel_by_hour
from wayfold.operators.visits import HOUR, hourly_records
from wayfold.sources.readers import scan_range
from wayfold.plans.timing import as_datetime, as_delta
from wayfold.sources.writers import chart_json

Time = str | datetime


def _labelled(df: DataFrame, value: str) -> DataFrame:
    labelled = df.withColumn("__at", F.col("startTime")).withColumn(
        "startTime", interval_label(F.col("__at"), HOUR)
    )
    return chart_json(labelled, ["startTime", value], "__at")


def hourly_frequency(
    snap: DataFrame, routes: DataFrame, station: int, start: Time, end: Time
) -> DataFrame:
    return _labelled(hourly_records(snap, routes, start, end, station=station), "freq")


def hourly_travel(
    snap: DataFrame, routes: DataFrame, station: int, start: Time, end: Time
) -> DataFrame:
    return _labelled(travel_by_hour(snap, routes, start, end, station=station), "travelTime")


def total_frequency(freq: DataFrame, routes: DataFrame, start: Time, end: Time) -> DataFrame:
    top = frequency_top(freq, routes, start, end).withColumnRenamed("station_id", "__id")
    return chart_json(top.withColumnRenamed("name", "station_id"), ["station_id", "freq"], ["freq", "__id"])


def mean_travel(travel: DataFrame, routes: DataFrame, start: Time, end: Time) -> DataFrame:
    top = travel_top(travel, routes, start, end).withColumnRenamed("station_id", "__id")
    return chart_json(
        top.withColumnRenamed("name", "station_id"), ["station_id", "travelTime"], ["travelTime", "__id"]
    )


def density(
    snap: DataFrame, start: Time, end: Time, rate: float = 1.0, longest: str | timedelta | None = None,
    candidates: int | None = None,
) -> DataFrame:
    """Dense areas of the whole range; their counts cover the ``candidates`` largest cells. A range over ``longest``, if given, is an error; the helper
    ``clamp_range`` cuts one for callers who want that."""
    if longest is not None and as_datetime(end) - as_datetime(start) > as_delta(longest):
        raise ValueError(f"the range is longer than {longest}")
    rows = scan_range(snap, "dateTime", start, end).select("lat", "lon", "event_id")
    return chart_json(dense_areas(rows, rate=rate, candidates=candidates), ["lat", "lon", "count"], ["count", "lat", "lon"])


def path(snap: DataFrame, station: int, start: Time, end: Time, rate: float = 1.0) -> DataFrame:
    rows = path_sample(snap, start, end, station=station, rate=rate)
    rows = rows.withColumn("__at", F.col("dateTime"))
    rows = rows.withColumn("dateTime", time_text(F.col("__at")))
    return chart_json(rows, ["lat", "lon", "dateTime"], ["stratum", "__at", "event_id"])


def routes_shown(routes: DataFrame) -> DataFrame:
    return chart_json(route_list(routes), ["station_id", "routeName"], "station_id")
