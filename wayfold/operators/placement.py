"""Placement of rows on groups by the range or the hash of a key."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wayfold.plans.joins import join_dim

Bound = tuple[object, str]
#: Up to so many bounds are one CASE; the code of more would not be compiled.
FEW = 64
#: Stretches that a table of bounds is cut into, about; their starts are the only bounds on the driver.
STRETCHES = 1024
#: Rows of a stretch that are placed together; larger stretches are dealt to as many groups as they need.
TOGETHER = 1_000_000


def _highest_not_above(value: Column, bounds: Sequence[Bound], below: Column) -> Column:
    """Group of the highest bound <= value, ``below`` under the lowest.

    The bounds become a balanced CASE, so a row makes log2(bounds) comparisons, all in codegen.
    """
    if not bounds:
        return below
    middle = len(bounds) // 2
    bound, group = bounds[middle]
    return F.when(
        value >= F.lit(bound), _highest_not_above(value, bounds[middle + 1:], F.lit(group))
    ).otherwise(_highest_not_above(value, bounds[:middle], below))


def _search(value: Column, bounds: Sequence[Bound], below: Column, kind: str) -> Column:
    """The same by binary search in a literal array: the plan has one literal, however many bounds."""
    if len(bounds) <= FEW:
        return _highest_not_above(value, bounds, below)
    keys, groups = (F.from_json(F.lit(json.dumps([b[i] for b in bounds])), f"array<{t}>") for i, t in enumerate((kind, "string")))
    powers = F.array(*(F.lit(1 << p) for p in reversed(range(len(bounds).bit_length()))))

    def not_above(v: Column) -> Column:
        return F.aggregate(powers, F.lit(0), lambda lo, step: F.when(F.get(keys, lo + step - 1) <= v, lo + step).otherwise(lo))

    # The array of one makes the key a variable, so that it is worked out once a row.
    count = F.get(F.transform(F.array(value), not_above), F.lit(0))
    return F.when(count == 0, below).otherwise(F.get(groups, count - 1))


def range_group(key: Column, bounds: Sequence[Bound]) -> Column:
    """Group by lower bounds of a whole-number key; null for keys under the lowest bound."""
    if not bounds:
        raise ValueError("placement needs a bound at least")
    ordered = sorted(((int(b), g) for b, g in bounds), key=lambda pair: pair[0])
    inside = _search(key, ordered, F.lit(None).cast("string"), "bigint")
    return F.when(key.isNotNull(), inside)


def hash_group(key: Column, bounds: Sequence[Bound]) -> Column:
    """Group by lower bounds of the upper-case hex MD5 of the key; below the lowest it wraps."""
    if not bounds:
        raise ValueError("placement needs a bound at least")
    ordered = sorted(((str(b), g) for b, g in bounds), key=lambda pair: pair[0])
    text = key.cast("string")
    inside = _search(F.upper(F.md5(text)), ordered, F.lit(ordered[-1][1]), "string")
    return F.when(text.isNotNull(), inside)


def place_range(
    df: DataFrame, key: str, bounds: Sequence[Bound], group: str = "group"
) -> DataFrame:
    return df.withColumn(group, range_group(F.col(key), bounds))


def place_hash(df: DataFrame, key: str, bounds: Sequence[Bound], group: str = "group") -> DataFrame:
    return df.withColumn(group, hash_group(F.col(key), bounds))


def _place_in_stretches(
    rows: DataFrame, bounds: DataFrame, kind: str, stretches: int, together: int, wrap: bool, group: str
) -> DataFrame:
    """``rows`` with ``__key`` beside the group of the highest ``bound`` not above it; see :func:`place_range_by`."""
    bounds = bounds.where("bound IS NOT NULL").groupBy("bound").agg(F.max("group").alias("group"))
    count = bounds.count()
    if not count:
        raise ValueError("placement needs a bound at least")
    each = max(1, count // stretches)
    starts = bounds.where(F.pmod(F.xxhash64("bound"), F.lit(each)) == 0) if each > 1 else bounds
    starts = sorted((r[0] for r in starts.select("bound").collect()))  # about STRETCHES of them, however many bounds there are
    stretch = _search(F.col("__key"), [(b, str(n)) for n, b in enumerate(starts)], F.lit("-1"), kind).cast("int")
    rows = rows.withColumn("__stretch", F.coalesce(stretch, F.lit(-1)))
    bounds = bounds.withColumnRenamed("bound", "__key").withColumn("__stretch", stretch)

    sizes = rows.groupBy("__stretch").agg(F.count("*").alias("__rows"))
    shares = sizes.select("__stretch", F.ceil(F.col("__rows") / F.lit(together)).cast("int").alias("__shares"))
    dealt = join_dim(rows, shares, "__stretch").withColumn("__share", F.pmod(F.monotonically_increasing_id(), F.col("__shares")).cast("int"))
    copied = bounds.join(shares, "__stretch").withColumn("__share", F.explode(F.sequence(F.lit(0), F.col("__shares") - 1)))
    both = dealt.withColumns({"group": F.lit(None).cast("string"), "__row": F.lit(1)}).drop("__shares").unionByName(
        copied.select("__key", "group", "__stretch", "__share", F.lit(0).alias("__row")), allowMissingColumns=True
    )
    so_far = Window.partitionBy("__stretch", "__share").orderBy("__key", "__row").rowsBetween(Window.unboundedPreceding, 0)
    placed = both.withColumn(group, F.last("group", ignorenulls=True).over(so_far)).where("__row = 1")
    if wrap:
        placed = placed.withColumn("__top", bounds.agg(F.max_by("group", "__key")).scalar())
        placed = placed.withColumn(group, F.when(F.col("__key").isNotNull(), F.coalesce(group, "__top"))).drop("__top")
    else:
        placed = placed.withColumn(group, F.when(F.col("__key").isNotNull(), F.col(group)))
    return placed.drop("__stretch", "__share", "__row", "__key", *(["group"] if group != "group" else []))


def place_range_by(
    df: DataFrame, key: str, bounds: DataFrame, group: str = "group", stretches: int = STRETCHES, together: int = TOGETHER
) -> DataFrame:
    """:func:`place_range` by a table of bounds (``bound``, ``group``) of any size, which is never collected.

    Some of the bounds, chosen by hash, cut the keys into stretches. A stretch begins with a bound, so that nothing need be carried into
    it; the first one is below the first of them. Bounds and rows of a stretch meet in key order, and each row takes the
    last bound before it. Stretches of very many rows, one key alone included, are dealt to several tasks, each
    with the stretch's bounds. Of equal bounds the greatest group holds.
    """
    table = bounds.select(F.col("bound").cast("bigint").alias("bound"), F.col("group").cast("string").alias("group"))
    rows = df.drop("group").withColumn("__key", F.col(key).cast("bigint"))
    placed = _place_in_stretches(rows, table, "bigint", stretches, together, False, group)
    return placed.select(*[c for c in df.columns if c != group], group)


def place_hash_by(
    df: DataFrame, key: str, bounds: DataFrame, group: str = "group", stretches: int = STRETCHES, together: int = TOGETHER
) -> DataFrame:
    """:func:`place_hash` by a table of bounds, in the same way; keys below the lowest bound wrap to the highest."""
    table = bounds.select(F.col("bound").cast("string").alias("bound"), F.col("group").cast("string").alias("group"))
    rows = df.drop("group").withColumn("__key", F.upper(F.md5(F.col(key).cast("string"))))
    placed = _place_in_stretches(rows, table, "string", stretches, together, True, group)
    return placed.select(*[c for c in df.columns if c != group], group)


def write_placed(
    df: DataFrame, path: str, key: str, bounds: Sequence[Bound],
    how: Callable[[Column, Sequence[Bound]], Column] = hash_group,
    global_group: str = "global", group: str = "group",
) -> None:
    """Write a table split by group; rows without a key go to the global group.

    A key that belongs to no group is an error, as a lookup of it would be. The rebalance hint
    splits a group that is too large for one task and keeps small groups to few files.
    """
    placed = how(F.col(key), bounds)
    unplaced = F.raise_error(F.concat(F.lit("no group for key "), F.col(key).cast("string")))
    target = F.when(F.col(key).isNull(), F.lit(global_group)).otherwise(
        F.coalesce(placed, unplaced.cast("string"))
    )
    (
        df.withColumn(group, target)
        .hint("rebalance", group)
        .write.mode("overwrite")
        .partitionBy(group)
        .parquet(path)
    )


def placement_counts(
    placed: DataFrame, bounds: Sequence[Bound], group: str = "group"
) -> DataFrame:
    """Rows per group; groups without rows count 0, rows without a group are left out."""
    counts = placed.groupBy(group).agg(F.count("*").alias("rows"))
    groups = placed.sparkSession.createDataFrame(
        [(g,) for g in sorted({g for _, g in bounds})], f"`{group}` string"
    )
    return groups.join(counts, group, "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
