"""One small frame per rule."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import LOOP, ROUTE, at, routes, rows, snapshots
from wayfold.operators import placement, density, geo, metrics, rollup, sampling, spine, trips, visits

START, END = "2024-01-01", "2024-01-02"


def test_gap_equal_to_the_limit_stays_in_the_visit(spark):
    snap = snapshots(spark, [("00:00", {}), ("00:15", {}), ("00:30:01", {})])
    found = visits.visits(snap, ["station_id", "vehicle_id"])
    assert rows(found.select("visit_start", "visit_end", "records")) == [
        (at("00:00"), at("00:15"), 2), (at("00:30:01"), at("00:30:01"), 1)
    ]
    daily = visits.daily_frequency(snap, routes(spark), START, END)
    assert [r.freq for r in daily.collect()] == [2]


def test_visits_across_a_slice_border(spark):
    """Records in neighbour slices and in slices with an empty one between."""
    snap = snapshots(spark, [("00:14:59", {}), ("00:15:01", {}), ("00:30:01", {}), ("00:45:02", {}), ("01:20", {})])
    assert rows(visits.visits(snap, ["vehicle_id"]).select("records")) == [(1,), (1,), (3,)]


def test_gap_of_zero_counts_distinct_times(spark):
    snap = snapshots(spark, [("00:00", {}), ("00:00", {}), ("00:01", {})])
    assert visits.visits(snap, ["vehicle_id"], gap=timedelta(0)).count() == 2


def test_vehicles_are_counted_once_each(spark):
    snap = snapshots(spark, [("00:00", {}), ("00:01", {"vehicle_id": 2}), ("00:02", {}), ("00:03", {"vehicle_id": 2})])
    assert [r.freq for r in visits.daily_frequency(snap, routes(spark), START, END).collect()] == [2]


def test_daily_visits_restart_at_the_day(spark):
    snap = snapshots(spark, [("23:55", {}), ("1 00:05", {})])
    found = visits.daily_frequency(snap, routes(spark), START, "2024-01-03")
    assert rows(found.select("startTime", "freq")) == [(at("00:00"), 1), (at("1 00:00"), 1)]


def test_only_complete_days(spark):
    snap = snapshots(spark, [("10:00", {}), ("1 10:00", {})])
    cut = "2024-01-02 23:00:00"
    with pytest.raises(ValueError, match="whole days"):
        visits.daily_frequency(snap, routes(spark), START, cut)
    with pytest.raises(ValueError, match="whole days"):
        trips.travel_by_bucket(snap, START, cut)
    assert visits.daily_frequency(snap, routes(spark), START, cut, partial=True).count() == 2


def test_loop_route_halves_and_rounds_down(spark):
    snap = snapshots(spark, [(f"{h:02d}:00", {"station_id": 2}) for h in range(5)])
    assert [r.freq for r in visits.daily_frequency(snap, routes(spark, LOOP), START, END).collect()] == [2]
    whole = visits.daily_frequency(snap, routes(spark, LOOP), START, END, scale=False)
    assert [r.freq for r in whole.collect()] == [5]


def test_empty_days_on_request(spark):
    snap = snapshots(spark, [("10:00", {})])
    found = visits.daily_frequency(snap, routes(spark, ROUTE, LOOP), START, "2024-01-03", keep_empty=True)
    assert rows(found) == [(1, at("00:00"), 1), (1, at("1 00:00"), 0), (2, at("00:00"), 0), (2, at("1 00:00"), 0)]


def test_weekly_is_seven_days_aligned_to_midnight(spark):
    snap = snapshots(spark, [("10:00", {}), ("6 23:59:59", {}), ("7 00:00", {})])
    found = visits.weekly_frequency(snap, routes(spark), "2024-01-08 09:00:00", station=1)
    assert [(r.startTime, r.freq) for r in found.orderBy("startTime").collect()] == [
        (at(f"{d} 00:00"), 1 if d in (0, 6) else 0) for d in range(7)
    ]


def test_box_is_closed_and_anchored_at_the_rounded_point(spark):
    frame = spark.createDataFrame([(1.0014, 1.003), (1.0014, 0.999), (1.0014, 1.00301), (1.0016, 1.0039)], "a double, x double")
    inside = geo.in_box(F.col("x"), F.col("x"), F.col("a"), F.col("a"))
    assert [r[0] for r in frame.select(inside).collect()] == [True, True, False, True]


def test_half_open_range(spark):
    from wayfold.sources.readers import scan_range

    snap = snapshots(spark, [("00:00", {}), ("01:00", {}), ("02:00", {})])
    kept = scan_range(snap, "dateTime", at("00:00"), at("02:00"))
    assert sorted(r.event_id for r in kept.collect()) == [0, 1]


def test_empty_windows_count_zero(spark):
    snap = snapshots(spark, [("01:10", {}), ("01:20", {})])
    found = visits.hourly_records(snap, routes(spark), "2024-01-01", "2024-01-01 03:00:00", station=1)
    assert [r.freq for r in found.orderBy("startTime").collect()] == [0, 2, 0]


def test_windows_count_from_the_asked_start(spark):
    snap = snapshots(spark, [("07:19", {}), ("07:20", {}), ("08:19:59", {}), ("08:20", {}), ("09:05", {})])
    found = visits.hourly_records(snap, routes(spark), "2024-01-01 07:20:00", "2024-01-01 09:00:00")
    assert rows(found.select("startTime", "freq")) == [(at("07:20"), 2), (at("08:20"), 1)]
    cut = spine.anchored_window(snap, "dateTime", "2024-01-01 07:20:00", "2024-01-01 09:00:00", "1 hour")
    assert cut.where("event_id = 3").first().endTime == at("09:00")


def test_hourly_visits_need_spacing_and_restart_each_window(spark):
    snap = snapshots(spark, [("00:00", {}), ("00:02", {}), ("00:05", {}), ("00:59", {}), ("01:00", {})])
    hours = (snap, routes(spark), "2024-01-01", "2024-01-01 03:00:00")
    assert [r.freq for r in visits.hourly_visits(*hours).orderBy("startTime").collect()] == [3, 1, 0]
    rest = visits.hourly_visits(*hours, count_first=False)
    assert [r.freq for r in rest.orderBy("startTime").collect()] == [2, 0, 0]


def test_flip_on_the_last_row(spark):
    snap = snapshots(spark, [("00:00", {}), ("00:20", {}), ("00:30", {"dirTag": "in"})])
    assert rows(trips.trips(snap).select("tag", "run_start", "duration_us")) == [("out", at("00:00"), 1_200_000_000)]


def test_runs_over_many_slices(spark):
    """A run through slices, flips inside a slice, and equal ends with another run between."""
    tags = [("00:00:10", "a"), ("00:03:00", "a"), ("00:03:10", "b"), ("00:03:20", "a"), ("00:09:00", "a"), ("00:09:30", "b")]
    snap = snapshots(spark, [(t, {"dirTag": tag}) for t, tag in tags])
    assert rows(trips.direction_runs(snap).select("tag", "run_start", "run_end", "records")) == [
        ("a", at("00:00:10"), at("00:03:00"), 2), ("a", at("00:03:20"), at("00:09:00"), 2),
        ("b", at("00:03:10"), at("00:03:10"), 1), ("b", at("00:09:30"), at("00:09:30"), 1),
    ]


def test_a_missing_direction_is_a_direction(spark):
    snap = snapshots(spark, [("00:00", {"dirTag": None}), ("00:20", {"dirTag": None}), ("00:21", {})])
    assert rows(trips.direction_runs(snap).select("tag", "records")) == [("out", 1), (None, 2)]


def test_minimum_is_strict(spark):
    snap = snapshots(spark, [("00:00", {}), ("00:08", {}), ("00:30", {"dirTag": "in"}), ("00:38:01", {"dirTag": "in"})])
    assert rows(trips.trips(snap).select("tag")) == [("in",)]


def test_trip_counts_in_the_bucket_of_its_start(spark):
    snap = snapshots(spark, [("03:50", {}), ("04:30", {}), ("1 05:00", {}), ("1 05:12:30", {})])
    found = trips.travel_by_bucket(snap, START, "2024-01-03")
    assert rows(found.select("startTime", "travelTime")) == [(at("00:00"), 40.0), (at("1 04:00"), 12.5)]


def test_travel_by_hour_rounds_half_up_and_fills(spark):
    snap = snapshots(spark, [("01:00", {}), ("01:12:30", {})])
    found = trips.travel_by_hour(snap, routes(spark), "2024-01-01", "2024-01-01 03:00:00", station=1)
    assert [r.travelTime for r in found.orderBy("startTime").collect()] == [0, 13, 0]


def test_ids(spark):
    snap = snapshots(spark, [("00:00", {"vehicle_id": v}) for v in (5, 3, 3, 9, 7)] + [("05:00", {"vehicle_id": 8})])
    lowest = trips.first_ids(snap, START, END)
    assert rows(lowest.select("vehicle_id")) == [(3,), (5,), (7,), (8,)]
    sampled = trips.sample_ids(snap, START, END)
    assert rows(sampled) == rows(trips.sample_ids(snap.repartition(7), START, END))
    assert len(rows(sampled)) == 4
    assert {r.vehicle_id for r in trips.keep_ids(snap, lowest).collect()} == {3, 5, 7, 8}


def test_first_arrival(spark):
    far = {"lat": 43.7}
    snap = snapshots(spark, [
        ("00:01", {"lat": 43.65}), ("00:05", {}), ("00:06", {"vehicle_id": 2}),
        ("00:10", far), ("00:13", far), ("00:13:01", far), ("00:20", far), ("00:14", far | {"vehicle_id": 2}),
        ("04:00", far),
    ])
    found = trips.first_arrival(snap, routes(spark), START, END)
    assert rows(found) == [(1, at("00:00"), 1, at("00:05"), at("00:13:01"), 481_000_000)]


def test_dense_areas_count_the_first_cell_once(spark):
    cells = [(43.1, -79.1, 10), (43.1005, -79.1, 5), (43.2, -79.2, 7)]
    points = spark.createDataFrame(
        [(i, lat, lon) for lat, lon, n in cells for i in range(n)], "event_id int, lat double, lon double"
    )
    assert rows(density.dense_areas(points)) == [(43.1, -79.1, 15), (43.2, -79.2, 7)]


def test_dense_areas_merge_against_the_anchor_and_stop_at_n(spark):
    lats = [43.1, 43.1015, 43.1025, 43.3, 43.301, 43.4]
    points = spark.createDataFrame([(0, lat, -79.0) for lat in lats], "event_id int, lat double, lon double")
    assert rows(density.dense_areas(points)) == [
        (43.1, -79.0, 2), (43.1025, -79.0, 1), (43.3, -79.0, 2), (43.4, -79.0, 1)
    ]
    assert rows(density.dense_areas(points, n=3)) == [(43.1, -79.0, 2), (43.1025, -79.0, 1), (43.3, -79.0, 2)]


def test_dense_areas_count_all_candidates(spark):
    """Cells of an area beyond the 2n largest are counted if there are candidates enough."""
    points = spark.createDataFrame([(n, 43.1 + n / 10_000, -79.1) for n in range(6)] + [(6, 43.1, -79.1)], "event_id int, lat double, lon double")
    assert [r["count"] for r in density.dense_areas(points, n=1).collect()] == [3]
    assert [r["count"] for r in density.dense_areas(points, n=1, candidates=10).collect()] == [7]


def test_dense_areas_merge_distance_is_exact(spark):
    points = spark.createDataFrame([(0, 43.6003, -79.0), (1, 43.6023, -79.0)], "event_id int, lat double, lon double")
    assert density.dense_areas(points).count() == 2


def test_no_points_no_areas(spark):
    points = spark.createDataFrame([], "event_id int, lat double, lon double")
    assert density.dense_areas(points).count() == 0


def test_rounding_to_the_grid(spark):
    frame = spark.createDataFrame([(43.66665, -79.41135)], "lat double, lon double")
    cell = frame.select(geo.grid_cell(F.col("lat")), geo.grid_cell(F.col("lon"))).first()
    assert tuple(cell) == (43.6666, -79.4113)


def test_strata_hold_both_ends(spark):
    """Values at both ends of the range fall in the first and the tenth stratum."""
    lats = [0.0] * 10 + [1.0] * 10
    snap = snapshots(spark, [("00:00", {"lat": lat, "lon": 0.0}) for lat in lats])
    found = sampling.path_sample(snap, START, END, station=1, k=1.0)
    assert {(r.lat, r.stratum) for r in found.collect()} == {(0.0, 0), (1.0, 9)}
    assert found.count() == 20


def test_strata_are_limited_and_one_place_is_one_stratum(spark):
    snap = snapshots(spark, [("00:00", {}) for _ in range(60)])
    found = sampling.path_sample(snap, START, END)
    assert found.count() == 40
    assert {r.stratum for r in found.select("stratum").collect()} == {0}


def test_a_cap_that_strata_do_not_divide_is_used_up(spark):
    snap = snapshots(spark, [("00:00", {"lat": lat / 100, "lon": 0.0}) for lat in range(100)])
    assert sampling.path_sample(snap, START, END, station=1, k=2.0, cap=15).count() == 15
    with pytest.raises(ValueError):
        sampling.path_sample(snap, START, END, station=1, cap=5)


def test_small_magnitudes_stay_within_sigma(spark):
    frame = spark.createDataFrame([(i * 9e-10, 0.0) for i in range(100)], "lat double, lon double")
    assert geo.within_sigma(frame, k=2.0).count() == 100


def test_placement_needs_a_bound(spark):
    for place in (placement.range_group, placement.hash_group):
        with pytest.raises(ValueError):
            place(F.lit(1), [])


def test_top_ten_breaks_ties_by_station(spark):
    facts = spark.createDataFrame([(s, at("00:00"), 5 if s < 12 else 9) for s in range(13)], "station_id int, startTime timestamp_ntz, freq bigint")
    top = rollup.frequency_top(facts, routes(spark), START, END)
    assert sorted(r.station_id for r in top.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 12]
    assert {r.name for r in top.where("station_id IN (1, 2)").collect()} == {"1 One", "2"}


def test_travel_top_cuts_to_whole_minutes(spark):
    facts = spark.createDataFrame([(1, at("00:00"), 9.9), (1, at("04:00"), 9.9)], "station_id int, startTime timestamp_ntz, travelTime double")
    assert rollup.travel_top(facts, routes(spark), START, END).first().travelTime == 9


def test_clamp():
    assert spine.clamp_range("2024-01-01 06:00:00", "2024-01-05") == (datetime(2024, 1, 1, 6), datetime(2024, 1, 2, 6))
    assert spine.clamp_range("2024-01-01", "2024-01-01 05:00:00")[1] == datetime(2024, 1, 1, 5)


def test_previous_day():
    assert spine.previous_day("2024-03-01 05:00:00") == (datetime(2024, 2, 29), datetime(2024, 3, 1))


def test_intervals(spark):
    assert spine.full_intervals(spark, "2024-01-01", "2024-01-03 12:00:00").count() == 2
    assert spine.full_intervals(spark, "2024-01-01", "2024-01-03 12:00:00", partial=True).count() == 3
    assert spine.full_intervals(spark, "2024-01-03", "2024-01-01").count() == 0
    assert spine.keyed_spine(routes(spark), "2024-01-03", "2024-01-03", "1 hour").count() == 0


def test_missing_days(spark):
    fact = spark.createDataFrame([(at("1 04:00"),)], "startTime timestamp_ntz")
    assert rows(spine.missing_days(fact, START, "2024-01-04")) == [(at("00:00"),), (at("2 00:00"),)]


def test_numeric_diff(spark):
    before = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "x"), ("d", "1.5")], "k string, v string")
    after = spark.createDataFrame([("a", "4"), ("b", "2"), ("c", "y"), ("d", "1"), ("e", "1")], "k string, v string")
    assert rows(metrics.numeric_diff(before, after, "k", "v")) == [("a", 3.0), ("d", -0.5)]


def test_histogram_edges(spark):
    """Width 1 at least; a value on a breakpoint belongs to that breakpoint's bucket."""
    frame = spark.createDataFrame([(v,) for v in (3.0, 3.0, 3.5, 4.0, 4.1)], "v double")
    found = metrics.histogram20(frame, "v").orderBy("bucket").collect()
    assert len(found) == 20
    assert [r["count"] for r in found[:4]] == [2, 2, 1, 0]
    assert [r["breakpoint"] for r in found[:3]] == [3.0, 4.0, 5.0]
    assert [r["bar"] for r in found[:4]] == ["*" * 20, "*" * 20, "*" * 10, ""]
    assert metrics.histogram20(frame.where("v < 0"), "v").count() == 0


def test_histogram_keeps_the_group_without_a_name(spark):
    frame = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, 50.0)], "g string, v double")
    found = metrics.histogram20(frame, "v", ["g"]).groupBy("g").agg(F.sum("count").alias("n"))
    assert rows(found) == [("a", 1), (None, 2)]


def test_margin_of_error(spark):
    frame = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)] + [("c", 1.0)] * 31, "g string, v double")
    found = {r.g: r for r in metrics.margin_of_error(frame, "v", ["g"]).collect()}
    assert found["a"].margin == pytest.approx(4.303 / 2**0.5)
    assert found["a"].confidence == pytest.approx(0.1 - 2 * 4.303 * 1.0 / 2.0)
    assert (found["b"].margin, found["b"].confidence) == (0.0, None)
    assert (found["c"].n, found["c"].margin) == (31, 0.0)
    wide = spark.createDataFrame([(float(i % 2),) for i in range(40)], "v double")
    for level, t in ((95, 2.021), (99, 2.704)):
        assert metrics.margin_of_error(wide, "v", level=level).first().margin == pytest.approx(t * 0.5 / 40**0.5, abs=1e-4)
    with pytest.raises(ValueError):
        metrics.margin_of_error(frame, "v", ["g"], level=90)


def test_abnormal_needs_enough_earlier_values(spark):
    def found(n):
        values = [1.0 + i % 2 for i in range(n)] + [100.0, 100.0]
        snap = snapshots(spark, [(at("00:00") + timedelta(seconds=20 * i), {"value": v}) for i, v in enumerate(values)])
        return [r.event_id for r in metrics.abnormal(snap, ["station_id"], ["dateTime", "event_id"], "value").collect()]

    assert found(14) == []
    assert found(15) == [15]
