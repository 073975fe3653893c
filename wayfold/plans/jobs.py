"""Batch jobs: fill the fact tables for the days they lack."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from wayfold.operators.endpoints import route_endpoints, update_endpoints
from wayfold.operators.spine import DAY, previous_day
from wayfold.operators.trips import travel_by_bucket
from wayfold.operators.visits import daily_frequency
from wayfold.plans.timing import as_datetime, interval_count
from wayfold.sources.writers import append_fact, days_of, days_present, mark_done

Time = str | datetime


def frequency_job(
    snap: DataFrame, routes: DataFrame, start: Time, end: Time, path: str, **options: object
) -> None:
    """Daily frequency of every route and day, zero rows included; the range is from midnight to midnight."""
    append_fact(daily_frequency(snap, routes, start, end, keep_empty=True, **options), path, within=(start, end))


def travel_job(snap: DataFrame, start: Time, end: Time, path: str, **options: object) -> None:
    """Mean trip minutes of every route and slot; the range is from midnight to midnight."""
    append_fact(travel_by_bucket(snap, start, end, **options), path, within=(start, end))


def yesterday(job: Callable[[datetime, datetime], None], now: Time) -> None:
    """Run a job over the calendar day before ``now``."""
    job(*previous_day(now))


def backfill(
    spark: SparkSession, path: str, start: Time, end: Time, job: Callable[[datetime, datetime], None]
) -> list[datetime]:
    """Run a job over each unbroken span of days the fact table lacks; returns those days.

    A table that is not there yet lacks all days. Days that were run and gave no rows are noted, so
    they are not run for ever. A range that does not begin and end at midnight is an error.
    """
    days_of(start, end)
    first, have = as_datetime(start), days_present(spark, path)
    asked = [first + n * DAY for n in range(interval_count(start, end, DAY))]
    todo = [day for day in asked if day.date() not in have]
    spans: list[list[datetime]] = []
    for day in todo:
        if spans and spans[-1][-1] + DAY == day:
            spans[-1].append(day)
        else:
            spans.append([day])
    for span in spans:
        job(span[0], span[-1] + DAY)
        mark_done(spark, path, [day.date() for day in span])
    return todo


def endpoint_job(
    routes: DataFrame, trips: DataFrame, stop_times: DataFrame, stops: DataFrame
) -> DataFrame:
    """Routes with start and end coordinates taken from their stops."""
    return update_endpoints(routes, route_endpoints(trips, stop_times, stops))
