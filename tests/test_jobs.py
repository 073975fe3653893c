"""Batch jobs and streams."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import DAY0, at, routes, rows, snapshots
from wayfold.operators import geo, visits
from wayfold.plans import jobs
from wayfold.sources import writers
from wayfold.streaming import counts


def test_backfill_runs_only_missing_days(spark, tmp_path):
    path, ran = str(tmp_path / "fact"), []
    snap = snapshots(spark, [(f"{d} 10:00", {}) for d in range(6)])

    def job(start, end):
        ran.append((start, end))
        jobs.frequency_job(snap, routes(spark), start, end, path)

    job(at("2 00:00"), at("3 00:00"))
    todo = jobs.backfill(spark, path, "2024-01-01", "2024-01-07", job)
    assert todo == [at(f"{d} 00:00") for d in (0, 1, 3, 4, 5)]
    assert ran[1:] == [(at("00:00"), at("2 00:00")), (at("3 00:00"), at("6 00:00"))]
    assert jobs.backfill(spark, path, "2024-01-01", "2024-01-07", job) == []
    found = spark.read.parquet(path).select("station_id", "startTime", "freq")
    assert rows(found) == [(1, at(f"{d} 00:00"), 1) for d in range(6)]


def test_backfill_begins_without_a_table_and_ends(spark, tmp_path):
    """A day without trips is run once, not for ever."""
    path = str(tmp_path / "travel")
    moves = [(f"{d} 10:{m:02d}", {"dirTag": tag}) for d in (0, 2) for m, tag in ((0, "out"), (10, "out"), (20, "in"), (30, "in"))]
    snap = snapshots(spark, moves)

    def job(start, end):
        jobs.travel_job(snap, start, end, path)

    assert jobs.backfill(spark, path, "2024-01-01", "2024-01-04", job) == [at(f"{d} 00:00") for d in (0, 1, 2)]
    assert jobs.backfill(spark, path, "2024-01-01", "2024-01-04", job) == []
    found = spark.read.parquet(path)
    assert {r.startTime.day for r in found.collect()} == {1, 3}


def test_a_day_that_turns_out_empty_loses_its_rows(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows_of = lambda *days: snapshots(spark, [(f"{d} 10:00", {}) for d in days])
    writers.append_fact(rows_of(0, 1, 2), path, "dateTime")
    writers.append_fact(rows_of(2), path, "dateTime", within=("2024-01-02", "2024-01-04"))
    assert sorted(r.dateTime.day for r in spark.read.parquet(path).collect()) == [1, 3]
    writers.append_fact(rows_of(), path, "dateTime", within=("2024-01-01", "2024-01-02"))
    assert sorted(r.dateTime.day for r in spark.read.parquet(path).collect()) == [3]


@pytest.mark.parametrize(("start", "end"), [("2024-01-01 06:00", "2024-01-02 06:00"), ("2024-01-01 06:00", "2024-01-02"), ("2024-01-01", "2024-01-01 12:00")])
def test_a_cut_day_is_an_error_and_loses_nothing(spark, tmp_path, start, end):
    path, snap = str(tmp_path / "fact"), snapshots(spark, [("1 05:00", {}), ("2 05:00", {})])
    jobs.frequency_job(snap, routes(spark), "2024-01-01", "2024-01-03", path)
    before = rows(spark.read.parquet(path))
    ran = []
    for job in (
        lambda: jobs.frequency_job(snap, routes(spark), start, end, path),
        lambda: jobs.travel_job(snap.limit(0), start, end, path, partial=True),
        lambda: jobs.backfill(spark, path, start, end, lambda *span: ran.append(span)),
        lambda: writers.append_fact(snap.limit(0), path, "dateTime", within=(start, end)),
    ):
        with pytest.raises(ValueError):
            job()
    assert rows(spark.read.parquet(path)) == before and not ran


def test_yesterday():
    ran = []
    jobs.yesterday(lambda start, end: ran.append((start, end)), "2024-01-03 05:00:00")
    assert ran == [(at("1 00:00"), at("2 00:00"))]


def _land(snap, path, batches):
    """The snapshots in time order, one file per batch."""
    ordered = snap.orderBy("dateTime").collect()
    size = -(-len(ordered) // batches)
    for i in range(0, len(ordered), size):
        part = snap.sparkSession.createDataFrame(ordered[i:i + size], snap.schema)
        part.coalesce(1).write.mode("append").parquet(path)


def _run(spark, snap, operator, tmp_path, batches=4):
    source = str(tmp_path / "in")
    _land(snap, source, batches)
    stream = spark.readStream.schema(snap.schema).option("maxFilesPerTrigger", 1).parquet(source)
    out = operator(stream)
    counts.run_available(out, str(tmp_path / "out"), str(tmp_path / "check"))
    return spark.read.schema(out.schema).parquet(str(tmp_path / "out"))


def _moving(spark):
    """Among them a gap of exactly 15 minutes."""
    minutes = [0, 5, 30, 64, 70, 100, 130, 131, 200, 215, 240, 300, 310, 420, 500, 600]
    return snapshots(spark, [(at("00:00") + timedelta(minutes=m), {"vehicle_id": int(m % 5 > 0)}) for m in minutes])


def test_stream_of_hourly_records_equals_the_batch(spark, tmp_path):
    snap = _moving(spark)
    found = _run(spark, snap, lambda s: counts.stream_hourly_records(s, routes(spark), "30 minutes"), tmp_path)
    closed = at("00:00") + timedelta(minutes=600 - 30)
    batch = visits.hourly_records(snap, routes(spark), "2024-01-01", "2024-01-02").where("freq > 0")
    want = batch.where(F.col("startTime") + F.expr("INTERVAL 1 HOUR") <= F.lit(str(closed)).cast("timestamp_ntz"))
    assert rows(found.withColumn("startTime", F.col("startTime").cast("timestamp_ntz"))) == rows(want)


def test_stream_of_visits_equals_the_batch(spark, tmp_path):
    snap = _moving(spark)
    found = _run(spark, snap, lambda s: counts.stream_visits(s, routes(spark), delay="30 minutes"), tmp_path)
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("visit_start", "visit_end")}
    closed = F.lit(str(at("00:00") + timedelta(minutes=600 - 30 - 15))).cast("timestamp_ntz")
    batch = visits.visits(geo.snap_in_box(snap, routes(spark)), ["station_id", "vehicle_id"])
    assert rows(found.withColumns(times)) == rows(batch.where(F.col("visit_end") <= closed))


def test_late_records_are_left_out(spark, tmp_path):
    snap = snapshots(spark, [("00:10", {}), ("05:00", {}), ("09:00", {}), ("12:00", {})])
    source = str(tmp_path / "in")
    _land(snap, source, 4)
    late = snapshots(spark, [("00:20", {})])
    stream = spark.readStream.schema(snap.schema).option("maxFilesPerTrigger", 1).parquet(source)
    out = counts.stream_hourly_records(stream, routes(spark), "1 hour")
    counts.run_available(out, str(tmp_path / "out"), str(tmp_path / "check"))
    late.write.mode("append").parquet(source)
    counts.run_available(out, str(tmp_path / "out"), str(tmp_path / "check"))
    found = spark.read.schema(out.schema).parquet(str(tmp_path / "out"))
    assert [r.freq for r in found.orderBy("startTime").collect()] == [1, 1, 1]


def test_stream_counts_visits_per_day(spark, tmp_path):
    """Equal to the batch for closed days: visits over midnight, gaps equal to the threshold, rows late within the delay, a loop route,
    and a restart from the checkpoint before every file."""
    from helpers import LOOP, ROUTE

    rng = random.Random(5)
    moves = sorted((rng.randrange(0, 6 * 1440), rng.choice([1, 1, 2]), rng.choice([1, 2])) for _ in range(900))
    moves += [(1435, 1, 1), (1450, 1, 1), (1465, 1, 1), (2870, 2, 2), (2885, 2, 2)]
    moves.sort()
    rows_ = [(DAY0 + timedelta(minutes=m), {"station_id": s, "vehicle_id": v}) for m, s, v in moves]
    end = [(DAY0 + timedelta(days=7, hours=2), {"station_id": 9})]
    whole = snapshots(spark, rows_ + end)
    source, stops = str(tmp_path / "in"), routes(spark, ROUTE, LOOP)
    # Each file ends with some rows that are up to half an hour older than its newest.
    size, found = 150, {}
    for at_ in range(0, len(rows_) + 1, size):
        part = rows_[at_ : at_ + size] + (end if at_ + size > len(rows_) else [])
        newest = max(t for t, _ in part)
        late = [r for r in part if newest - r[0] < timedelta(minutes=30)]
        part = [r for r in part if r not in late] + late[::-1]
        frame = snapshots(spark, part)
        frame.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(source)
        days = counts.stream_daily_visits(stream, stops)
        counts.run_available(days, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        out = spark.read.schema(days.schema).parquet(str(tmp_path / "out")).collect()
        assert len({(r.station_id, r.startTime) for r in out}) == len(out)
        assert set(found) <= {tuple(r) for r in out}
        found = {tuple(r) for r in out}
    want = visits.daily_frequency(whole, stops, "2024-01-01", "2024-01-09").where("station_id < 9")
    assert {(r[0], r[1].replace(tzinfo=None), r[2]) for r in found} == {tuple(r) for r in want.collect()}
    assert len(found) == 12


def test_a_stream_leaves_the_session_as_it_was(spark, tmp_path):
    snap = snapshots(spark, [("10:00", {}), ("10:05", {}), ("5 10:00", {})])
    snap.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(snap.schema).parquet(str(tmp_path / "in"))
    before = spark.conf.get(counts.MERGE_EARLY)
    query = counts.run_available(counts.stream_visits(stream, routes(spark)), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert spark.conf.get(counts.MERGE_EARLY) == before == "false"
    plan = query._jsq.streamingQuery().lastExecution().executedPlan().toString()
    assert "MergingSessions" in plan.split("Exchange", 1)[1]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
