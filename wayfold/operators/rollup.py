"""Rollups over the fact tables, names, ordered rows and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from wayfold.plans.joins import join_dim
from wayfold.plans.ranking import numbered, tie_break
from wayfold.sources.readers import scan_range

# Fixed value: bars in a summary chart.
TOP = 10
#: Up to so many rows are kept by every task and met in one; further rows are found by their position.
FAR = 10_000


def display_name(station_id: Column, name: Column) -> Column:
    """``"<id> <name>"``, or the id alone if there is no name."""
    return F.concat_ws(" ", station_id.cast("string"), name)


def with_names(df: DataFrame, routes: DataFrame, name: str = "name") -> DataFrame:
    """Add the display name of each row's station."""
    named = join_dim(df, routes.select("station_id", "station_name"), "station_id", "left")
    return named.withColumn(name, display_name(F.col("station_id"), F.col("station_name"))).drop(
        "station_name"
    )


def frequency_top(
    freq: DataFrame, routes: DataFrame, start: str | datetime, end: str | datetime, n: int = TOP
) -> DataFrame:
    """The ``n`` stations with the highest total frequency in a range."""
    totals = (
        scan_range(freq, "startTime", start, end)
        .groupBy("station_id")
        .agg(F.sum("freq").alias("freq"))
        .orderBy(F.desc("freq"), "station_id")
        .limit(n)
    )
    return with_names(totals, routes)


def travel_top(
    travel: DataFrame, routes: DataFrame, start: str | datetime, end: str | datetime, n: int = TOP
) -> DataFrame:
    """The ``n`` stations with the highest mean travel time in a range, cut to whole minutes.

    The order is that of the mean rounded to 6 decimals, so that it does not hang on the order in
    which doubles were added.
    """
    means = (
        scan_range(travel, "startTime", start, end)
        .groupBy("station_id")
        .agg(F.round(F.avg("travelTime"), 6).alias("__mean"))
        .orderBy(F.desc("__mean"), "station_id")
        .limit(n)
    )
    whole = means.select("station_id", F.col("__mean").cast("int").alias("travelTime"))
    return with_names(whole, routes)


def route_list(routes: DataFrame) -> DataFrame:
    """Station ids and route names in key order."""
    return routes.select("station_id", F.col("station_name").alias("routeName")).orderBy("station_id")


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def distinct_ids(df: DataFrame, cols: Sequence[str] = ("vehicle_id",)) -> DataFrame:
    return df.select(*cols).distinct()


def nth_row(df: DataFrame, order: Sequence[str | Column], n: int, far: int = FAR) -> DataFrame:
    """The row at position ``n``, counted from 0; of rows equal in ``order``, by a hash of the row."""
    if n < far:
        return df.orderBy(*order, tie_break(df)).offset(n).limit(1)
    return numbered(df, order, "__at").where(F.col("__at") == n).drop("__at")


def cap_rows(df: DataFrame, order: Sequence[str | Column], n: int, far: int = FAR) -> DataFrame:
    """At most ``n`` rows of the whole result; 0 means no cap. Rows equal in ``order`` are ordered by a hash of the row."""
    if not n:
        return df.orderBy(*order)
    if n <= far:
        return df.orderBy(*order, tie_break(df)).limit(n)
    return numbered(df, order, "__at").where(F.col("__at") < n).orderBy("__at").drop("__at")


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both by position, each once."""
    return left.union(right).distinct()
