"""Connected components of a distributed edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wayfold.llm.common import kept


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``edges`` (a, b) to (node, component): the smallest node that links reach, for every node with a link.

    Each round ties larger neighbours to the smallest one, then smaller ones, until nothing changes.
    The minimum per node is pre-aggregated and joined, so a hot node is never one group in memory.
    Nodes without links are not listed; an empty edge list gives no rows.
    """
    now = kept(edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo < hi").distinct(), "edges")
    for _ in range(rounds):
        both = now.union(now.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
        least = both.groupBy("lo").agg(F.least(F.col("lo"), F.min("hi")).alias("root"))
        large = both.join(least, "lo").where("hi > lo").select(F.col("root").alias("lo"), "hi").where("lo < hi").distinct()
        large = kept(large, "large")
        least = large.groupBy("hi").agg(F.min("lo").alias("root"))
        joined = large.join(least, "hi")
        small = joined.select(F.col("root").alias("lo"), F.col("lo").alias("hi")).where("lo < hi").union(
            joined.select(F.col("root").alias("lo"), "hi")
        ).distinct()
        small = kept(small, "small")
        done = small.exceptAll(now).isEmpty() and now.exceptAll(small).isEmpty()
        now = small
        if done:
            break
    else:
        raise RuntimeError("links did not settle")
    tied = now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return tied.union(now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
