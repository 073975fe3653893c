"""Sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayfold.plans.timing import as_datetime

Time = str | datetime
#: Folder inside a table, unseen by its readers, with an empty file for every day that a backfill has run.
DONE = "_days_done"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``. Only a local session, which has one machine, may leave that unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file:///tmp/checkpoints"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: what reads it starts there, also after executors are lost."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def days_of(start: Time, end: Time) -> list[date]:
    """The days of [start, end); an error unless both are midnights, as a cut day has rows outside the range."""
    first, last = as_datetime(start), as_datetime(end)
    if any(t.time() != time.min for t in (first, last)):
        raise ValueError(f"the range of a write must begin and end at midnight, not {first} to {last}")
    return [first.date() + timedelta(days=n) for n in range((last - first).days)]


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system that Spark reads; none if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def mark_done(spark: SparkSession, path: str, days: Sequence[date]) -> None:
    """Notes days as run, whether or not they have rows."""
    for d in days:
        file = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{DONE}/{d.isoformat()}")
        file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file, True).close()


def days_present(spark: SparkSession, path: str, day: str = "day") -> set[date]:
    """Days of a table that have a partition or are noted as run; none if the table is not there yet.

    Only names of folders are read: as many as the table has days.
    """
    parts = [n.removeprefix(f"{day}=") for n in _names(spark, path) if n.startswith(f"{day}=")]
    return {date.fromisoformat(n) for n in [*parts, *_names(spark, f"{path}/{DONE}")] if n[:1].isdigit()}


def append_fact(
    df: DataFrame, path: str, ts: str = "startTime", day: str = "day",
    within: tuple[Time, Time] | None = None,
) -> None:
    """Write facts (or snapshots) by day; writing a day again replaces it, other days stay.

    ``within`` is the range that was computed, from midnight to midnight: a day of it that has no rows now loses
    those it had. Any other range is an error, raised before anything is written.
    The rebalance hint gives few files per day and splits a day that is too large for one task.
    """
    spark = df.sparkSession
    asked = [f"{path}/{day}={d.isoformat()}" for d in days_of(*within)] if within else []
    before = {folder: set(_names(spark, folder)) for folder in asked}
    (
        df.withColumn(day, F.col(ts).cast("date"))
        .hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )
    # Files of a write have a name of their own, so a folder with the same names was not written.
    for folder, names in before.items():
        if names and names == set(_names(spark, folder)):
            _remove(spark, folder)


def chart_json(
    df: DataFrame, cols: Sequence[str], order_by: str | Column | Sequence[str | Column]
) -> DataFrame:
    """One JSON object per row, fields in the order of ``cols``, rows ordered by ``order_by``."""
    order = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    return df.orderBy(*order).select(F.to_json(F.struct(*cols)).alias("json"))


def write_chart_json(
    df: DataFrame, cols: Sequence[str], order_by: str | Sequence[str], path: str
) -> None:
    chart_json(df, cols, order_by).write.mode("overwrite").text(path)
