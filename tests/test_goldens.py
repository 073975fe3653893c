"""Placement and EXISTS cases with known answers."""

import bisect
import hashlib
import time

import pytest
from pyspark.sql import functions as F

from helpers import rows
from wayfold.operators import placement, rollup

RANGE = [(bound, f"shard_group_{i}") for i, bound in enumerate((1, 10000, 1001, 400, 1000, 470))]
HASH = [
    (bound, f"server_group_{i}")
    for i, bound in enumerate(("A" * 32, "6" * 32, "2809A05A22A4A9C1882A580BCC0AD8A6", "D" * 32))
]


def test_range_bounds_belong_to_their_own_group(spark):
    keys = spark.createDataFrame([(b,) for b, _ in RANGE], "key bigint")
    assert dict(rows(placement.place_range(keys, "key", RANGE))) == dict(RANGE)


def test_keys_under_the_lowest_bound_have_no_group(spark):
    keys = spark.createDataFrame([(0,), (-999,), (None,), (2**40,)], "key bigint")
    found = dict(rows(placement.place_range(keys, "key", RANGE)))
    assert found == {0: None, -999: None, None: None, 2**40: "shard_group_1"}


def test_many_bounds(spark):
    """10,000 bounds are planned at once and give what a search by hand gives."""
    by_range = [(7 * i, f"g{i}") for i in range(10_000)]
    by_hash = [(f"{i * 0x10000000:032X}", f"g{i}") for i in range(1, 10_000)]
    keys = spark.createDataFrame([(k,) for k in (-1, 0, 6, 7, 69_992, 69_993, 10**9, None)], "key bigint")
    begun = time.perf_counter()
    both = keys.select("key", placement.range_group(F.col("key"), by_range).alias("r"), placement.hash_group(F.col("key"), by_hash).alias("h"))
    both._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - begun < 5
    names = [b for b, _ in by_hash]
    for key, r, h in both.collect():
        if key is None:
            assert r is h is None
            continue
        assert r == (None if key < 0 else f"g{min(key // 7, 9_999)}")
        at = bisect.bisect_right(names, hashlib.md5(str(key).encode()).hexdigest().upper())
        assert h == by_hash[at - 1][1]


def test_hash_groups(spark):
    golden = {"Jess": 2, "x": 1, "X": 3, "Y": 2, "g": 0, "168": 3}
    keys = spark.createDataFrame([(k,) for k in golden], "key string")
    found = dict(rows(placement.place_hash(keys, "key", HASH)))
    assert found == {k: f"server_group_{g}" for k, g in golden.items()}


def test_every_key_is_placed_by_hash(spark):
    keys = spark.range(1000).withColumnRenamed("id", "key")
    assert placement.place_hash(keys, "key", HASH).where("group IS NULL").count() == 0


def test_counts_include_empty_groups(spark):
    keys = spark.createDataFrame([(5,), (6,), (450,), (0,)], "key bigint")
    found = dict(rows(placement.placement_counts(placement.place_range(keys, "key", RANGE), RANGE)))
    assert found == {f"shard_group_{i}": {0: 2, 3: 1}.get(i, 0) for i in range(6)}


def test_write_placed(spark, tmp_path):
    keys = spark.createDataFrame([(5,), (450,), (None,)], "key bigint")
    path = str(tmp_path / "placed")
    placement.write_placed(keys, path, "key", RANGE, placement.range_group)
    assert rows(spark.read.parquet(path).select("key", F.col("group").cast("string"))) == [
        (450, "shard_group_3"), (5, "shard_group_0"), (None, "global")
    ]
    with pytest.raises(Exception, match="no group for key 0"):
        placement.write_placed(
            spark.createDataFrame([(0,)], "key bigint"), path, "key", RANGE, placement.range_group
        )


@pytest.fixture(scope="module")
def tables(spark):
    def frame(schema, *data):
        return spark.createDataFrame(list(data), schema)

    return {
        "t1": frame("colA string, colB int", ("abcd", 1), ("efgh", 2), ("ijkl", 3)).withColumn(
            "colB", F.col("colB").cast("decimal(3,0)")
        ),
        "t2": frame("colA string, colB string", ("type1", "1"), ("type2", "2"), ("type3", "3")),
        "t3": frame("colA string, colB string", ("aaaa", "abcd"), ("bbbb", "efgh"), ("cccc", "ijkl")),
        "t4": frame("colA string, colB string", ("abcd", "type1"), ("efgh", "type2"), ("ijkl", "type3")),
    }


@pytest.mark.parametrize(
    "statement, expected",
    [
        ("SELECT {t3}.colA FROM {t3}, {t1} WHERE {t3}.colA = 'bbbb' AND {t3}.colB = {t1}.colA AND EXISTS "
         "(SELECT 'X' FROM {t2} WHERE CAST({t2}.colB AS DECIMAL(3, 0)) = {t1}.colB)", [("bbbb",)]),
        ("SELECT {t3}.colA FROM {t3}, {t1} WHERE {t3}.colA = 'bbbb' AND {t3}.colB = {t1}.colA AND EXISTS "
         "(SELECT 'X' FROM {t2} WHERE CAST({t2}.colB AS INT) = 2)", [("bbbb",)]),
        ("SELECT colA, CAST(colB AS INT) FROM {t1} WHERE colA = 'efgh' AND EXISTS "
         "(SELECT 'X' FROM {t2} WHERE CAST({t2}.colB AS DECIMAL(3, 0)) = {t1}.colB)", [("efgh", 2)]),
        ("SELECT {t1}.colA FROM {t1}, {t4} WHERE {t4}.colA = {t1}.colA AND EXISTS "
         "(SELECT 'X' FROM {t2} WHERE {t2}.colA = {t4}.colB)", [("abcd",), ("efgh",), ("ijkl",)]),
    ],
)
def test_exists(spark, tables, statement, expected):
    assert rows(spark.sql(statement, **{n: t for n, t in tables.items() if f"{{{n}}}" in statement})) == expected


def test_union(tables):
    found = rollup.union_distinct(tables["t2"].select("colA", F.lit("")), tables["t3"])
    assert rows(found) == [
        ("aaaa", "abcd"), ("bbbb", "efgh"), ("cccc", "ijkl"), ("type1", ""), ("type2", ""), ("type3", "")
    ]
