"""The operators' input tables, derived from the given tables, in Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

START = "2024-01-01 00:00:00"
END = "2024-01-31 00:00:00"


# Columns of the given tables; declared, so that a read opens no file to find them out.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snap_of(table(spark, sf_dir, "events"))


def snap_of(events: DataFrame) -> DataFrame:
    """Snapshots from events. The usual shape of the property is read without a JSON parser, which
    is several times faster; any other text falls back to it."""
    usual = F.regexp_extract("props", r'\A\{"k": *(-?\d{1,9})\}\z', 1).try_cast("int")
    k = F.col("__k")
    parsed = F.coalesce(usual, F.get_json_object("props", "$.k").cast("int"))
    return events.withColumn("__k", parsed).select(
        "event_id",
        (F.col("user_id") % 25).cast("int").alias("station_id"),
        (F.col("user_id") % 50).cast("int").alias("vehicle_id"),
        F.col("ts").alias("dateTime"),
        k.alias("nbBikes"),
        F.when(k < 50, "out").otherwise("in").alias("dirTag"),
        (F.lit(43.6003) + (k % 20) / F.lit(1000.0)).alias("lat"),
        (F.lit(-79.3997) + (F.col("event_id") % 10) / F.lit(1000.0)).alias("lon"),
        "value",
    )


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")

    def lat(number):
        return F.lit(43.6) + (number % 20) / F.lit(1000.0)

    start_lon = F.lit(-79.4) + (n % 10) / F.lit(1000.0)
    return table(spark, sf_dir, "nation").select(
        n.alias("station_id"),
        F.col("n_name").alias("station_name"),
        lat(n).alias("start_lat"),
        start_lon.alias("start_lon"),
        F.when(n % 5 == 0, lat(n)).otherwise(lat(n + 10)).alias("end_lat"),
        start_lon.alias("end_lon"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.col("o_orderkey").alias("trip_id"), F.col("o_custkey").alias("station_id"))


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("trip_id"),
        F.col("l_linenumber").alias("stop_sequence"),
        F.col("l_suppkey").alias("stop_id"),
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("stop_id"),
        F.col("s_acctbal").alias("stop_lat"),
        F.col("s_nationkey").alias("stop_lon"),
    )


# The same views as common table expressions, by name; each may use those before it.
SQL_VIEWS = {
    "snap": """
        SELECT event_id, CAST(user_id % 25 AS INT) AS station_id, CAST(user_id % 50 AS INT) AS vehicle_id,
               ts AS dateTime, k AS nbBikes, CASE WHEN k < 50 THEN 'out' ELSE 'in' END AS dirTag,
               43.6003::DOUBLE + (k % 20) / 1000.0::DOUBLE AS lat,
               -79.3997::DOUBLE + (event_id % 10) / 1000.0::DOUBLE AS lon, value
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""",
    "routes": """
        SELECT n_nationkey AS station_id, n_name AS station_name,
               43.6::DOUBLE + (n_nationkey % 20) / 1000.0::DOUBLE AS start_lat,
               -79.4::DOUBLE + (n_nationkey % 10) / 1000.0::DOUBLE AS start_lon,
               43.6::DOUBLE + ((CASE WHEN n_nationkey % 5 = 0 THEN n_nationkey ELSE n_nationkey + 10 END) % 20)
                   / 1000.0::DOUBLE AS end_lat,
               -79.4::DOUBLE + (n_nationkey % 10) / 1000.0::DOUBLE AS end_lon
        FROM nation""",
    "trips": "SELECT o_orderkey AS trip_id, o_custkey AS station_id FROM orders",
    "stop_times": """
        SELECT l_orderkey AS trip_id, l_linenumber AS stop_sequence, l_suppkey AS stop_id FROM lineitem""",
    "stops": "SELECT s_suppkey AS stop_id, s_acctbal AS stop_lat, s_nationkey AS stop_lon FROM supplier",
}


def sql_box(lat: str, lon: str, anchor: str, tol: str) -> str:
    return (
        f"{lat} BETWEEN round({anchor}_lat, 3) - {tol}::DOUBLE AND round({anchor}_lat, 3) + {tol}::DOUBLE AND "
        f"{lon} BETWEEN round({anchor}_lon, 3) - {tol}::DOUBLE AND round({anchor}_lon, 3) + {tol}::DOUBLE"
    )


def sql_factor(tol: str = "0.002") -> str:
    return f"CASE WHEN {sql_box('end_lat', 'end_lon', 'start', tol)} THEN 2 ELSE 1 END"


def sql_hits(anchor: str = "start", tol: str = "0.002") -> str:
    """Snapshots in their route's box."""
    return f"""
        SELECT s.*, {sql_factor(tol)} AS factor
        FROM snap s JOIN routes r USING (station_id) WHERE {sql_box('lat', 'lon', anchor, tol)}"""


def sql_daily(tol: str = "0.002", gap_us: int = 900_000_000, hits: str = "hits") -> str:
    """Daily frequency from row-level gaps."""
    return f"""
        SELECT station_id, startTime, CAST(sum(opens) // max(factor) AS BIGINT) AS freq
        FROM (
            SELECT station_id, factor, date_trunc('day', dateTime)::TIMESTAMP AS startTime,
                   CASE WHEN coalesce(epoch_us(dateTime) - epoch_us(lag(dateTime) OVER w) <= {gap_us}, false)
                        THEN 0 ELSE 1 END AS opens
            FROM {hits}
            WINDOW w AS (PARTITION BY station_id, vehicle_id, date_trunc('day', dateTime) ORDER BY dateTime)
        ) GROUP BY station_id, startTime"""


def sql_runs(restart: str | None = None) -> str:
    """Direction runs from row-level changes, cut at ``restart`` units if given."""
    part = f"date_trunc('{restart}', dateTime)" if restart else "0"
    return f"""
        SELECT station_id, vehicle_id, min(dirTag) AS tag, min(dateTime) AS run_start, max(dateTime) AS run_end,
               count(*) AS records
        FROM (
            SELECT *, sum(changed) OVER (PARTITION BY station_id, vehicle_id, part ORDER BY dateTime, event_id) AS run
            FROM (
                SELECT *, {part} AS part,
                       CASE WHEN dirTag IS DISTINCT FROM lag(dirTag) OVER w THEN 1 ELSE 0 END AS changed
                FROM snap
                WINDOW w AS (PARTITION BY station_id, vehicle_id, {part} ORDER BY dateTime, event_id)
            )
        ) GROUP BY station_id, vehicle_id, part, run"""


TRIPS_WHERE = "epoch_us(run_end) - epoch_us(run_start) > 480000000"
MINUTES = "sum(epoch_us(run_end) - epoch_us(run_start)) / (count(*) * 60e6::DOUBLE)"


def sql_spine(step: str, table_name: str = "routes") -> str:
    """Every station once per step of the whole range."""
    last = {"DAY": "2024-01-30 00:00:00", "HOUR": "2024-01-30 23:00:00"}[step]
    return f"""
        SELECT station_id, unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '{last}',
                                                  INTERVAL 1 {step})) AS startTime
        FROM {table_name}"""


def sql(select: str, views: str = "", **ctes: str) -> str:
    """A statement with the named views and further common table expressions in front."""
    parts = [f"{name} AS ({SQL_VIEWS[name]})" for name in views.split()]
    parts += [f"{name} AS ({text})" for name, text in ctes.items()]
    return f"WITH {', '.join(parts)}\n{select}" if parts else select
