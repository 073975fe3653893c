"""The first rows of each group, for groups of any size, and the position of rows in a whole order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from wayfold.sources.writers import written

# Setting: up to how many rows a group Spark limits ranks before the shuffle.
EARLY_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
SPREAD = 256
_IN_PART = 33  # bits of a row's place within its partition


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    """The first ``n`` rows of each group in ascending order.

    Up to a setting of Spark, each task keeps only its own first ``n`` before the shuffle. Beyond
    that it does not, so a group is first ranked in 256 parts, and then the first of each part.
    """
    if n > int(df.sparkSession.conf.get(EARLY_LIMIT)):
        part = F.pmod(F.xxhash64(*order), F.lit(SPREAD))
        df = _ranked(df.withColumn("__part", part), [*keys, "__part"], order, n).drop("__part")
    return _ranked(df, keys, order, n)


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def tie_break(df: DataFrame) -> Column:
    """A hash of the row, so that rows equal in an order have the same order among them in every run."""
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*(F.col(f"`{name}`") for name in hashed))


def numbered(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Every row with its position in the whole ``order``, counted from 0.

    Rows are dealt in ranges of the order and written; each partition's rows are counted, and a row's position is its
    place in its partition plus the rows of all partitions before. Rows equal in the order are ordered by a hash of the row;
    their number as dealt parts equal ones, so that they need not go to one task either. The running count is over one row
    per partition.
    """
    ties = df.withColumns({"__tie": tie_break(df), "__dealt": F.monotonically_increasing_id()})
    by = [*order, "__tie", "__dealt"]
    dealt = ties.repartitionByRange(*by).sortWithinPartitions(*by).drop("__tie", "__dealt")
    placed = written(dealt.withColumn("__place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__place", _IN_PART)
    counts = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__rows"))
    ahead = F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    before = counts.select("__part", F.coalesce(ahead, F.lit(0)).alias("__before"))
    inside = F.col("__place") - F.shiftleft("__part", _IN_PART)
    found = placed.withColumn("__part", part).join(before, "__part").withColumn(name, F.col("__before") + inside)
    return found.select(*df.columns, name)
