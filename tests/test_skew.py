"""Brute force on frames where one key holds a third of all rows, and results that must not move
when the input is split or shuffled."""

import random
from collections import defaultdict
from datetime import datetime, timedelta
from statistics import mean, stdev

import pytest

from helpers import DAY0, ROUTE, routes, rows, snapshots
from wayfold.operators import metrics, trips, visits
from wayfold.plans.joins import join_dim

KEYS = ["station_id", "vehicle_id"]


@pytest.fixture(scope="module")
def records():
    rng = random.Random(7)
    found = []
    for i in range(6000):
        vehicle = 0 if i % 3 == 0 else rng.randrange(1, 40)
        when = DAY0 + timedelta(seconds=rng.randrange(0, 3 * 86400))
        tag = rng.choice(["out", "in"]) if vehicle else ("out" if when.hour % 2 else "in")
        value = 5000.0 if rng.random() < 0.002 else rng.gauss(100, 10)
        found.append((when, {"vehicle_id": vehicle, "dirTag": tag, "value": round(value, 2)}))
    return found


@pytest.fixture(scope="module")
def snap(spark, records):
    return snapshots(spark, records).cache()


def grouped(records, *more):
    groups = defaultdict(list)
    for i, (when, over) in enumerate(records):
        groups[(over["vehicle_id"], *(f(when) for f in more))].append((when, i, over))
    return {k: sorted(v, key=lambda r: r[:2]) for k, v in groups.items()}


def test_visits(snap, records):
    gap, want = timedelta(minutes=15), []
    for (vehicle,), rs in grouped(records).items():
        begin, last, n = rs[0][0], rs[0][0], 0
        for when, _, _ in rs:
            if when - last > gap:
                want.append((1, vehicle, begin, last, n))
                begin, n = when, 0
            last, n = when, n + 1
        want.append((1, vehicle, begin, last, n))
    assert rows(visits.visits(snap, KEYS)) == sorted(want, key=repr)


def test_daily_frequency(spark, snap, records):
    counts = defaultdict(int)
    for (_, day), rs in grouped(records, lambda t: t.date()).items():
        times = [r[0] for r in rs]
        counts[day] += 1 + sum(b - a > timedelta(minutes=15) for a, b in zip(times, times[1:]))
    found = visits.daily_frequency(snap, routes(spark), "2024-01-01", "2024-01-04")
    assert {r.startTime.date(): r.freq for r in found.collect()} == counts


@pytest.mark.parametrize("restart", [None, "1 day"])
@pytest.mark.parametrize("width", ["1 second", "1 minute", "5 hours"])
def test_direction_runs(snap, records, restart, width):
    want = []
    split = [lambda t: t.date()] if restart else []
    for (vehicle, *_), rs in grouped(records, *split).items():
        runs = []
        for when, _, over in rs:
            if runs and runs[-1][0] == over["dirTag"]:
                runs[-1][2:] = [when, runs[-1][3] + 1]
            else:
                runs.append([over["dirTag"], when, when, 1])
        want += [(1, vehicle, *run) for run in runs]
    found = trips.direction_runs(snap, restart=restart, slice_width=width)
    assert rows(found) == sorted(want, key=repr)


@pytest.mark.parametrize("width", ["1 second", "1 minute", "10 days"])
def test_abnormal(snap, records, width):
    want = []
    for _, rs in grouped(records).items():
        values = [r[2]["value"] for r in rs]
        for i, (_, event, over) in enumerate(rs):
            if i >= 15 and over["value"] > mean(values[:i]) + 5 * stdev(values[:i]):
                want.append(event)
    found = metrics.abnormal(snap, KEYS, ["dateTime", "event_id"], "value", slice_width=width)
    assert want
    assert sorted(r.event_id for r in found.collect()) == sorted(want)


def test_abnormal_far_from_zero(spark):
    rng = random.Random(3)
    values = [1e9 + rng.gauss(0, 1) + (60 if i % 50 == 49 else 0) for i in range(400)]
    begun = datetime(2024, 1, 1)
    frame = spark.createDataFrame([(1, begun + timedelta(seconds=7 * i), i, v) for i, v in enumerate(values)], "k int, t timestamp_ntz, e long, v double")
    shifted = [v - 1e9 for v in values]
    want = [i for i, v in enumerate(shifted) if i >= 15 and v > mean(shifted[:i]) + 3 * stdev(shifted[:i])]
    found = metrics.abnormal(frame, ["k"], ["t", "e"], "v", k=3.0)
    assert sorted(r.e for r in found.collect()) == want


@pytest.mark.parametrize(
    "operator",
    [
        lambda s, r: visits.visits(s, KEYS),
        lambda s, r: visits.daily_frequency(s, r, "2024-01-01", "2024-01-04"),
        lambda s, r: visits.hourly_visits(s, r, "2024-01-01", "2024-01-04"),
        lambda s, r: trips.direction_runs(s),
        lambda s, r: trips.first_arrival(s, r, "2024-01-01", "2024-01-04"),
        lambda s, r: metrics.histogram20(s, "value", KEYS),
    ],
)
def test_partitioning_of_the_input_does_not_matter(spark, snap, operator):
    looped = routes(spark, ROUTE | {"end_lat": 43.6})
    assert rows(operator(snap, looped)) == rows(operator(snap.repartition(13, "value"), looped))


def test_days_can_be_run_apart(spark, snap):
    whole = visits.daily_frequency(snap, routes(spark), "2024-01-01", "2024-01-04")
    days = [visits.daily_frequency(snap, routes(spark), f"2024-01-0{d}", f"2024-01-0{d + 1}") for d in (1, 2, 3)]
    assert rows(whole) == sorted(sum((rows(d) for d in days), []), key=repr)
    trip_days = [trips.travel_by_bucket(snap, f"2024-01-0{d}", f"2024-01-0{d + 1}") for d in (1, 2, 3)]
    whole = trips.travel_by_bucket(snap, "2024-01-01", "2024-01-04")
    assert rows(whole) == sorted(sum((rows(d) for d in trip_days), []), key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_keys_of_two_integer_types_meet(spark, how):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    dim = spark.createDataFrame([(1, 10), (2**40, 20)], "k bigint, w int")
    found = join_dim(fact, dim, "k", how)
    assert rows(found) == rows(fact.join(dim, "k", how))
    assert found.schema["k"].dataType == fact.schema["k"].dataType
    with pytest.raises(ValueError, match="key k is int"):
        join_dim(fact, dim.selectExpr("CAST(k AS STRING) AS k"), "k", how)


def test_a_hot_key_is_split_in_a_join_beyond_the_broadcast_limit(spark):
    """Adaptive execution splits the hot partition although a grouping on the same key follows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(0, 60000, 1, 8).selectExpr("IF(id % 3 = 0, 7, id % 1000) AS k", "id AS v")
        dim = spark.range(1000).selectExpr("id AS k", "id * 2 AS w")
        joined = join_dim(fact, dim, "k").groupBy("k").sum("w")
        found = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(found) == 1000
    assert "skew=true" in plan or "isSkew=true" in plan
