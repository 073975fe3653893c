"""Published runs, their log, and changes merged into a stored table."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import at, routes, rows, snapshots
from wayfold.operators.endpoints import apply_changes
from wayfold.operators.visits import daily_frequency
from wayfold.sources import ledger


def facts(spark, *days, value=1):
    return spark.createDataFrame([(d, at(f"{d} 00:00"), value) for d in days], "station_id int, startTime timestamp_ntz, freq int")


def files(path):
    return {f for folder, _, names in os.walk(f"{path}/runs") for f in (os.path.join(folder, n) for n in names) if f.endswith(".parquet")}


def shown(spark, path, start="2024-01-01", end="2024-01-08"):
    return sorted((r.station_id, r.freq) for r in ledger.read_published(spark, path, start, end).collect())


def test_a_run_replaces_its_days_at_once(spark, tmp_path):
    path = str(tmp_path / "t")
    ledger.publish_days(facts(spark, 0, 1, 2), path, "2024-01-01", "2024-01-05")
    assert shown(spark, path) == [(0, 1), (1, 1), (2, 1)]
    before = files(path)
    ledger.publish_days(facts(spark, 1, value=5), path, "2024-01-02", "2024-01-04")
    assert shown(spark, path) == [(0, 1), (1, 5)]
    assert shown(spark, path, "2024-01-02", "2024-01-03") == [(1, 5)]
    assert before < files(path)
    have = {r.part: (r.state, r.rows) for r in ledger.states(spark, path).collect()}
    assert have == {"2024-01-01": ("COMPLETE", 1), "2024-01-02": ("COMPLETE", 1), "2024-01-03": ("COMPLETE", 0), "2024-01-04": ("COMPLETE", 0)}


@pytest.mark.parametrize("dies", ["while it writes", "before it publishes"])
def test_a_run_that_dies_leaves_the_old_days_whole(spark, tmp_path, monkeypatch, dies):
    path = str(tmp_path / "t")
    ledger.publish_days(facts(spark, 0, 1), path, "2024-01-01", "2024-01-03")
    new = facts(spark, 0, 1, value=9)
    if dies == "while it writes":
        new = new.withColumn("freq", F.when(F.col("station_id") == 1, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("freq")))
        state = "FAILED"
    else:
        noted = ledger.note
        killed = lambda spark, path, entries: noted(spark, path, entries) if entries[0][2] == "START" else (_ for _ in ()).throw(KeyboardInterrupt)
        monkeypatch.setattr(ledger, "note", killed)
        state = "START"
    with pytest.raises(BaseException):  # noqa: B017
        ledger.publish_days(new, path, "2024-01-01", "2024-01-03")
    monkeypatch.undo()
    assert shown(spark, path) == [(0, 1), (1, 1)]
    assert {r.state for r in ledger.states(spark, path).collect()} == {state}
    assert ledger.open_days(spark, path, "2024-01-01", "2024-01-04") == {date(2024, 1, 1): state, date(2024, 1, 2): state, date(2024, 1, 3): None}
    ledger.publish_days(facts(spark, 0, 1, value=9), path, "2024-01-01", "2024-01-03")
    assert shown(spark, path) == [(0, 9), (1, 9)]


def test_days_are_filled_and_failed_ones_run_again(spark, tmp_path):
    path, ran = str(tmp_path / "t"), []
    snap = snapshots(spark, [(f"{d} 10:00", {}) for d in range(6)])
    broken = [True]

    def compute(start, end):
        ran.append((start.day, end.day))
        if broken[0] and start.day == 4:
            raise RuntimeError("no source")
        return daily_frequency(snap, routes(spark), start, end, keep_empty=True)

    ledger.publish_days(compute(at("2 00:00"), at("3 00:00")), path, "2024-01-03", "2024-01-04")
    ran.clear()
    failed = ledger.fill_days(spark, path, "2024-01-01", "2024-01-08", compute)
    assert list(failed) == [date(2024, 1, d) for d in (4, 5, 6, 7)] and "no source" in failed[date(2024, 1, 4)]
    assert ran == [(1, 3), (4, 8)]
    assert ledger.open_days(spark, path, "2024-01-03", "2024-01-09") == {date(2024, 1, d): "FAILED" if d < 8 else None for d in range(4, 9)}
    broken[0] = False
    assert ledger.fill_days(spark, path, "2024-01-01", "2024-01-08", compute, longest=3) == {}
    assert ran[2:] == [(4, 7), (7, 8)]
    assert ledger.fill_days(spark, path, "2024-01-01", "2024-01-08", compute) == {} and len(ran) == 4
    found = ledger.read_published(spark, path, "2024-01-01", "2024-01-08")
    assert rows(found) == rows(daily_frequency(snap, routes(spark), "2024-01-01", "2024-01-08", keep_empty=True))


def test_only_whole_days_and_own_parts(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError):
        ledger.publish_days(facts(spark, 0), path, "2024-01-01 06:00", "2024-01-02")
    with pytest.raises(ValueError):
        ledger.read_published(spark, path, "2024-01-01", "2024-01-02")
    with pytest.raises(Exception, match="a row of part 2024-01-03"):
        ledger.publish_days(facts(spark, 0, 2), path, "2024-01-01", "2024-01-02")
    with pytest.raises(ValueError):
        ledger.publish(facts(spark, 0), path, F.lit("a/b"), ["a/b"])
    ledger.publish_days(facts(spark), path, "2024-01-01", "2024-01-02")
    assert shown(spark, path) == [] and ledger.read_parts(spark, path).columns == ["station_id", "startTime", "freq", "part"]


def test_only_days_of_the_range_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    ledger.publish_days(facts(spark, 0, 1, 2, 3), path, "2024-01-01", "2024-01-05")
    got = ledger.read_published(spark, path, "2024-01-02", "2024-01-03")
    assert {name.split("part=")[1][:10] for name in got.inputFiles()} == {"2024-01-02", "2024-01-03"}


BASE = "id long, grp string, v string"


@pytest.mark.parametrize("broadcast", [True, False])
def test_merge_rewrites_touched_parts_only(spark, tmp_path, broadcast):
    path = str(tmp_path / "t")
    base = spark.createDataFrame([(i, f"g{i % 5}", f"v{i}") for i in range(100)] + [(None, "g4", "no key")], BASE)
    ledger.publish(base, path, F.col("grp"), [f"g{k}" for k in range(5)])
    before = files(path)
    changes = spark.createDataFrame(
        [(5, "g0", "x", "update", 1), (5, "g0", "y", "update", 2), (10, "g0", "", "delete", 1), (16, "g2", "moved", "update", 1), (500, "g7", "new", "insert", 1), (900, "g0", "", "delete", 3)],
        f"{BASE}, op string, at int",
    )
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old if broadcast else "-1")
    try:
        assert ledger.merge(spark, path, changes, ["id"], "op", ["at"], F.col("grp")) == ["g0", "g1", "g2", "g7"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    got = rows(ledger.read_parts(spark, path).select("id", "grp", "v"))
    assert got == rows(apply_changes(base, changes, ["id"], "op", ["at"]))
    want = {(i, f"g{i % 5}", f"v{i}") for i in range(100) if i not in (5, 10, 16)} | {(None, "g4", "no key"), (5, "g0", "y"), (16, "g2", "moved"), (500, "g7", "new")}
    assert set(got) == want and len(got) == len(want)
    live = set(ledger.read_parts(spark, path).inputFiles())
    untouched = {f"file://{f}" for f in before if "part=g3" in f or "part=g4" in f}
    assert untouched and untouched <= live
    assert ledger.merge(spark, path, changes.where("false"), ["id"], "op", ["at"], F.col("grp")) == []


def test_few_changes_do_not_shuffle_the_base(spark):
    base = spark.range(100_000).select(F.col("id"), F.lit("a").alias("v"))
    changes = spark.range(5).select(F.col("id"), F.lit("b").alias("v"), F.lit("update").alias("op"))
    plan = apply_changes(base, changes, ["id"], "op", ["v"])._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("LeftAnti") :]
    assert "BroadcastHashJoin" in plan and side.index("Range") < side.index("Exchange")
