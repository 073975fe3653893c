"""Random values against plain Python."""

import hashlib
import random
import re
from collections import Counter
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from wayfold.operators import density, endpoints, metrics, placement, quality, rollup, sampling, spine
from wayfold.plans import ranking
from wayfold.plans.ranking import top_per_group
from wayfold.plans.timing import as_delta, interval_count

TIMES = st.datetimes(datetime(2000, 1, 1), datetime(2030, 1, 1))
STEPS = st.timedeltas(timedelta(seconds=1), timedelta(days=40))


@given(TIMES, TIMES, STEPS)
def test_interval_count(start, end, step):
    whole = interval_count(start, end, step)
    assert whole == 0 or start + whole * step <= end
    assert start + (whole + 1) * step > end
    assert interval_count(start, end, step, partial=True) - whole in (0, 1)


@given(TIMES, st.integers(1, 30))
def test_trailing_range(end, days):
    first, last = spine.trailing_range(end, days)
    assert last <= end < last + spine.DAY
    assert last - first == days * spine.DAY and first.time() == datetime.min.time()


@given(TIMES, TIMES, STEPS)
def test_clamp_range(start, end, longest):
    assert spine.clamp_range(start, end, longest)[1] - start <= max(longest, end - start)
    assert spine.clamp_range(start, end, longest)[1] <= end


@given(st.integers(1, 10**6), st.sampled_from(["second", "seconds", "minute", "hours", "days"]))
@settings(max_examples=20)
def test_widths(number, unit):
    assert as_delta(f"{number} {unit}") == as_delta(timedelta(**{unit.rstrip("s") + "s": number}))


def wild_regex(pattern):
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            i += 1
            out += re.escape(pattern[i])
        else:
            out += {"%": ".*", "_": "."}.get(c) or re.escape(c)
        i += 1
    return re.compile(out, re.DOTALL | re.IGNORECASE)


def test_wild_match(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("aAb%_\\\n") for _ in range(rng.randrange(0, 7))) for _ in range(300)]
    patterns = ["".join(rng.choice("ab%_\\") for _ in range(rng.randrange(0, 6))) for _ in range(25)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    found = frame.select("t", *[quality.wild_match(F.col("t"), p).alias(f"p{i}") for i, p in enumerate(patterns)])
    for row in found.collect():
        for p, hit in zip(patterns, row[1:]):
            assert hit == bool(wild_regex(p).fullmatch(row.t)), (row.t, p)


@pytest.mark.parametrize("count", [1, 2, 3, 50])
def test_placement(spark, count):
    rng = random.Random(count)
    numbers = rng.sample(range(-500, 500), count)
    by_range = [(n, f"g{i}") for i, n in enumerate(numbers)]
    by_hash = [("".join(rng.choice("0123456789ABCDEF") for _ in range(32)), f"g{i}") for i in range(count)]
    frame = spark.range(-600, 600).select("id", placement.range_group(F.col("id"), by_range).alias("r"),
                                          placement.hash_group(F.col("id"), by_hash).alias("h"))
    for key, r, h in frame.collect():
        below = [b for b in by_range if b[0] <= key]
        assert r == (max(below)[1] if below else None)
        digest = hashlib.md5(str(key).encode()).hexdigest().upper()
        assert h == max([b for b in by_hash if b[0] <= digest] or by_hash)[1]


def test_dense_areas(spark):
    rng = random.Random(5)
    points = [(i, 43 + rng.randrange(200) / 10000, -79 + rng.randrange(3) / 1000) for i in range(3000)]
    frame = spark.createDataFrame(points, "event_id int, lat double, lon double")
    cells = Counter((round(lat * 10000), round(lon * 10000)) for _, lat, lon in points)
    top = sorted(sorted(cells.items(), key=lambda c: (-c[1], c[0]))[:16])
    areas = []
    for (lat, lon), n in top:
        if areas and (lat - areas[-1][0]) ** 2 + (lon - areas[-1][1]) ** 2 < 400:
            areas[-1][2] += n
        elif len(areas) < 8:
            areas.append([lat, lon, n])
    found = density.dense_areas(frame, n=8).collect()
    assert [(r.lat, r.lon, r["count"]) for r in found] == [(a / 10000, o / 10000, n) for a, o, n in areas]


@pytest.mark.parametrize("n", [1, 40, 1500])
def test_first_rows_of_a_hot_group(spark, n):
    rng = random.Random(n)
    data = [(0 if i % 3 == 0 else rng.randrange(1, 9), rng.randrange(10**6), i) for i in range(9000)]
    frame = spark.createDataFrame(data, "g int, v int, i int").repartition(11)
    groups = {}
    for g, v, i in sorted(data):
        groups.setdefault(g, []).append((g, v, i))
    want = {row for rows in groups.values() for row in rows[:n]}
    found = top_per_group(frame, ["g"], [F.col("v"), F.col("i")], n)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("Window [row_number()") == (2 if n > 1000 else 1)
    assert ("WindowGroupLimit" in text) == (n <= 1000)
    assert {tuple(r) for r in found.collect()} == want


def test_sample_is_the_same_everywhere(spark):
    frame = spark.range(20000)
    kept = {r.id for r in sampling.hash_sample(frame, "id", 0.3).collect()}
    assert kept == {r.id for r in sampling.hash_sample(frame.repartition(17), "id", 0.3).collect()}
    assert 0.28 < len(kept) / 20000 < 0.32
    assert kept != {r.id for r in sampling.hash_sample(frame, "id", 0.3, seed="other").collect()}


def test_changes_replay_like_a_dictionary(spark):
    rng = random.Random(11)
    table = {i: f"v{i}" for i in range(200)}
    base = spark.createDataFrame(list(table.items()), "id int, v string")
    changes = []
    for n in range(3000):
        key = 5 if n % 3 == 0 else rng.randrange(300)
        op = "delete" if rng.random() < 0.3 else "insert" if key not in table else "update"
        changes.append((key, f"c{n}", op, n))
        table.pop(key, None)
        if op != "delete":
            table[key] = f"c{n}"
    frame = spark.createDataFrame(changes, "id int, v string, op string, n int")
    found = endpoints.apply_changes(base, frame.repartition(9), ["id"], "op", ["n"])
    assert dict(tuple(r) for r in found.collect()) == table


def _walked(points, reach):
    cells, out = {}, []
    for a, b in points:
        cells[a, b] = cells.get((a, b), 0) + 1
    for (a, b), n in sorted(cells.items()):
        if out and (a - out[-1][0]) ** 2 + (b - out[-1][1]) ** 2 < reach * reach:
            out[-1][2] += n
        else:
            out.append([a, b, n])
    return sorted(map(tuple, out))


AREA_SHAPES = {
    "block": lambda r: [(r.randrange(120), r.randrange(-60, 60)) for _ in range(2500)],
    "line that never meets itself": lambda r: [(k * 3, 0) for k in range(300)] + [(2500 + k, k % 7) for k in range(100)],
    "thin road": lambda r: [(k + r.randrange(3), r.randrange(-3, 3)) for k in range(600)],
    "far apart": lambda r: [(r.randrange(-5000, 5000), r.randrange(5000)) for _ in range(600)] * 2,
    "one cell": lambda r: [(5, -5)] * 9,
}


@pytest.mark.parametrize("shape", AREA_SHAPES)
@pytest.mark.parametrize("tol", [0.002, 0.00055])
def test_all_areas_equal_a_sequential_walk(spark, shape, tol):
    points = AREA_SHAPES[shape](random.Random(3))
    frame = spark.createDataFrame([(a / 1e4, b / 1e4) for a, b in points] + [(None, 1.0)], "lat double, lon double").repartition(5)
    found = density.all_areas(frame, tol=tol).collect()
    assert sorted((round(r.lat * 1e4), round(r.lon * 1e4), r["count"]) for r in found) == _walked(points, tol * 1e4)


def test_the_densest_areas_are_whole(spark):
    points = AREA_SHAPES["block"](random.Random(4))
    frame = spark.createDataFrame([(a / 1e4, b / 1e4) for a, b in points], "lat double, lon double")
    want = sorted((-n, a, b) for a, b, n in _walked(points, 20))[:5]
    assert [(-r["count"], round(r.lat * 1e4), round(r.lon * 1e4)) for r in density.dense_areas_exact(frame, n=5).collect()] == want
    assert density.all_areas(frame.where("false")).count() == 0
    with pytest.raises(ValueError):
        density.all_areas(frame, tol=0)


@pytest.mark.parametrize("equal", [False, True])
def test_positions_in_an_order(spark, equal):
    """Also where a third of all rows are the same."""
    rng = random.Random(6)
    rows = [(rng.randrange(40), rng.choice([None, "a", "b"]), n) for n in range(900)]
    rows = [(7, "a", 0) if equal and n % 3 == 0 else r for n, r in enumerate(rows)]
    frame = spark.createDataFrame(rows, "k int, s string, n int").repartition(6)
    order = [F.desc("k"), F.asc_nulls_last("s")]
    key = lambda r: (-r[0], r[1] is None, r[1] or "")
    want = sorted(rows, key=key)
    found = sorted(map(tuple, ranking.numbered(frame, order, "at").collect()), key=lambda r: r[3])
    assert [r[3] for r in found] == list(range(900))
    assert [key(r) for r in found] == [key(r) for r in want] and sorted(map(repr, (r[:3] for r in found))) == sorted(map(repr, rows))
    for n in (0, 450, 899, 900):
        near, far = (rollup.nth_row(frame, order, n, far=f).collect() for f in (1000, 0))
        assert near == far and len(far) == (n < 900)
    near, far = (rollup.cap_rows(frame, order, 450, far=f).collect() for f in (1000, 0))
    assert near == far and [key(r) for r in far] == [key(r) for r in want[:450]]


def test_a_far_row_needs_no_single_task(spark):
    """The only plan node of one partition counts rows of partitions."""
    frame = spark.range(5000).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("m"))
    plan = rollup.cap_rows(frame, ["m"], 2500, far=0)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "GlobalLimit" not in plan
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert len(single) == 1 and "rangepartitioning" in plan
    assert "HashAggregate" in plan[plan.index("SinglePartition") : plan.index("SinglePartition") + 400]


@pytest.mark.parametrize(("stretches", "together"), [(1024, 1_000_000), (7, 50), (1, 10)])
def test_placement_by_a_table_equals_that_by_a_list(spark, stretches, together):
    """Hot keys, keys under the lowest bound, null keys, keys that are bounds; bounds few and many."""
    rng = random.Random(9)
    keys = [None, -5, 0] + [rng.randrange(-100, 5000) for _ in range(500)] + [1234] * 300
    frame = spark.createDataFrame([(k, n, "clash") for n, k in enumerate(keys)], "key long, n int, bound string").repartition(4)
    for count in (1, 5, 300):
        own = [(b, f"g{b % 11}") for b in rng.sample(range(0, 4000), count)]
        table = spark.createDataFrame([*own, (None, "none")], "bound long, `group` string")
        got = placement.place_range_by(frame, "key", table, stretches=stretches, together=together)
        assert got.columns == ["key", "n", "bound", "group"]
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, placement.place_range(frame, "key", own).collect()))
        hashed = [(hashlib.md5(str(n).encode()).hexdigest().upper(), f"h{n % 7}") for n in range(count)]
        table = spark.createDataFrame(hashed, "bound string, `group` string")
        got = placement.place_hash_by(frame, "key", table, "home", stretches, together)
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, placement.place_hash(frame, "key", hashed, "home").collect()))
    with pytest.raises(ValueError):
        placement.place_range_by(frame, "key", table.where("false"))


def test_a_million_bounds_stay_in_tasks(spark):
    bounds = spark.range(1_000_000).select((F.col("id") * 7).alias("bound"), F.concat(F.lit("g"), F.col("id")).alias("group"))
    rows = spark.range(200_000).select((F.col("id") * 37 - 50).alias("key"))
    got = placement.place_range_by(rows, "key", bounds)
    want = F.when(F.col("key") >= 0, F.concat(F.lit("g"), F.least(F.floor(F.col("key") / 7), F.lit(999_999))))
    assert got.where(~F.col("group").eqNullSafe(want)).count() == 0 and got.count() == 200_000
    assert got.select("group").distinct().count() > 180_000


@pytest.mark.parametrize("offset", [0.0, 1e9])
def test_merged_moments_equal_direct_ones(spark, offset):
    """Days of one row, of none and of many, groups without a name, values far from zero."""
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(40), offset + rng.random()) for _ in range(3000)]
    rows += [("c", 1, offset + 2.5), ("d", 1, None), ("a", 99, None)]
    frame = spark.createDataFrame(rows, "kind string, day int, v double").repartition(5)
    days = metrics.moments(frame, "v", ["kind", "day"])
    direct = {r.kind: r for r in metrics.moments(frame, "v", ["kind"]).collect()}
    merged = {r.kind: r for r in metrics.merge_moments(days, ["kind"]).collect()}
    assert set(merged) == set(direct) == {"a", "b", "c", None}
    for kind, r in merged.items():
        values = [v for k, _, v in rows if k == kind and v is not None]
        mean = offset + sum(v - offset for v in values) / len(values)
        m2 = sum((v - mean) ** 2 for v in values)
        assert (r.n, r.lowest, r.highest) == (len(values), min(values), max(values))
        assert abs(r.mean - mean) <= 1e-9 * max(1.0, abs(mean)) and abs(r.m2 - m2) <= 1e-6 * max(1.0, m2)
        assert abs(r.mean - direct[kind].mean) <= 1e-9 * max(1.0, abs(mean))
    whole = metrics.merge_moments(days).collect()
    assert [r.n for r in whole] == [sum(r.n for r in direct.values())]
    assert metrics.merge_moments(days.where("false")).count() == 0
    assert not [r for r in metrics.margin_of(metrics.merge_moments(days, ["kind"]), ["kind"]).collect() if r.n > 1 and not r.margin > 0]
