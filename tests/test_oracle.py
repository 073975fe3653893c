"""Every query against its SQL; those without SQL must at least return rows."""

import os

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from oracle import compare, connect, sf_dir
from wayfold.operators import geo, metrics, trips, visits
from wayfold.suite import views

SF = os.environ.get("ORACLE_SF", "0.01")


@pytest.fixture(scope="module")
def con():
    return connect(sf_dir(SF))


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, sf_dir(SF))
    if name in oracle_sql():
        assert compare(df, con, oracle_sql()[name]) is None
    else:
        assert not df.isEmpty()


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["station_id", "startTime", "freq"]
    assert df.count() > 0


def test_published_totals(spark):
    """Counts that were worked out before any of this was written."""
    found = queries()
    totals = {}
    for name in ("daily_frequency", "daily_frequency_wide"):
        rows = found[name](spark, sf_dir("0.01")).collect()
        totals[name] = (len(rows), sum(r.freq for r in rows))
    assert totals == {"daily_frequency": (446, 625), "daily_frequency_wide": (740, 1973)}


@pytest.mark.parametrize(
    "sf, box, visits_, runs, trips_, arrivals, abnormal",
    [
        ("0.001", (59, 448), (59, 438, 347), 507, 246, (3, 115), 5),
        ("0.01", (701, 4119), (694, 3985, 2204), 4887, 2451, (100, 630), 30),
        ("0.1", (6766, 41251), (6478, 30335, 1606), 50267, 20732, (703, 750), 257),
    ],
)
def test_published_counts(spark, sf, box, visits_, runs, trips_, arrivals, abnormal):
    snap, routes = views.snap(spark, sf_dir(sf)), views.routes(spark, sf_dir(sf))
    narrow, wide = (geo.snap_in_box(snap, routes, tol=tol) for tol in (0.002, 0.006))

    def daily(hits, gap):
        hits = hits.withColumn("day", F.col("dateTime").cast("date"))
        counts = visits.visit_counts(hits, ["station_id", "day"], ["vehicle_id"], gap=gap)
        return counts.agg(F.sum("visits")).first()[0]

    assert (narrow.count(), wide.count()) == box
    assert (daily(narrow, "15 minutes"), daily(wide, "15 minutes"), daily(wide, "6 hours")) == visits_
    assert (trips.direction_runs(snap).count(), trips.trips(snap).count()) == (runs, trips_)
    assert arrivals == tuple(
        trips.first_arrival(snap, routes, views.START, views.END, width="1 day", tol=tol).count()
        for tol in (0.002, 0.006)
    )
    found = metrics.abnormal(snap, ["station_id"], ["dateTime", "event_id"], "value")
    assert found.count() == abnormal
