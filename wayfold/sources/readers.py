"""Scans and sources."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wayfold import schemas
from wayfold.plans.timing import as_datetime, ts_literal


def scan_range(
    df: DataFrame,
    ts: str,
    start: str | datetime,
    end: str | datetime,
    key_col: str | None = None,
    key: object = None,
) -> DataFrame:
    """Rows with ``start <= ts < end``, optionally of one key only."""
    col = F.col(ts)
    kept = df.where((col >= ts_literal(df, ts, start)) & (col < ts_literal(df, ts, end)))
    return kept if key_col is None else kept.where(F.col(key_col) == F.lit(key))


def read_days(
    spark: SparkSession,
    path: str,
    start: str | datetime,
    end: str | datetime,
    ts: str = "startTime",
    day: str = "day",
) -> DataFrame:
    """Half-open range of a table partitioned by day; only files of its days are read."""
    first, last = (F.lit(as_datetime(t).date()) for t in (start, end))
    days = spark.read.parquet(path).where(F.col(day).between(first, last))
    return scan_range(days, ts, start, end).drop(day)


def scan_points(
    df: DataFrame, start: str | datetime, end: str | datetime, ts: str = "dateTime"
) -> DataFrame:
    """Only the coordinates of the records in a time range."""
    return scan_range(df, ts, start, end).select("lat", "lon")


def load_routes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ROUTES).parquet(path)


def route_start(routes: DataFrame, station_id: int) -> DataFrame:
    """Start coordinates of one route."""
    return routes.where(F.col("station_id") == F.lit(station_id)).select("start_lat", "start_lon")


def jdbc_options(
    url: str,
    query: str,
    partition: tuple[str, object, object, int] | None = None,
    **options: object,
) -> dict[str, str]:
    """Options of a JDBC read of a parenthesised subquery.

    ``partition`` is (column, lower bound, upper bound, number of partitions); without it the
    whole result comes through one task, so give it for anything large.
    """
    inner = query.strip().rstrip(";")
    result = {"url": url, "dbtable": f"({inner}) AS T"}
    if partition is not None:
        column, lower, upper, count = partition
        result |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(count),
        }
    return result | {name: str(value) for name, value in options.items()}


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    partition: tuple[str, object, object, int] | None = None,
    **options: object,
) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, query, partition, **options)).load()


def read_json_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed records, one JSON object per line; a malformed line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def load_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = "\t",
    null_text: str = "\\N",
    quote: str = "",
    escape: str = "\\",
) -> DataFrame:
    """Bulk load of a delimited file; the defaults are tab, ``\\N`` for null and no quoting."""
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("nullValue", null_text)
        .option("quote", quote)
        .option("escape", escape)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
