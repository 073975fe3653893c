"""Registry of queries; a case without SQL has a test of its own instead."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Case:
    query: Query
    sql: str | None


CASES: dict[str, Case] = {}


def case(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        if name in CASES:
            raise ValueError(f"query {name} is registered twice")
        CASES[name] = Case(query, sql)
        return query

    return register


def load() -> dict[str, Case]:
    from wayfold.suite import (  # noqa: F401
        cases_cleaning, cases_metrics, cases_paths, cases_rollups, cases_scans, cases_trips, cases_visits,
    )

    return CASES
