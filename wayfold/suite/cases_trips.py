"""Trips, travel times, arrivals, sampled ids, set operations."""

from pyspark.sql import functions as F

from wayfold.operators import rollup, trips as t
from wayfold.plans import charts
from wayfold.plans.jobs import travel_job
from wayfold.sources.writers import shared_dir
from wayfold.suite.registry import case
from wayfold.suite.views import (
    END, MINUTES, START, TRIPS_WHERE, routes, snap, sql, sql_hits, sql_runs, sql_spine, table,
)


@case("direction_runs", sql(sql_runs(), "snap"))
def _(spark, sf):
    return t.direction_runs(snap(spark, sf))


@case("direction_runs_daily", sql(sql_runs("day"), "snap"))
def _(spark, sf):
    return t.direction_runs(snap(spark, sf), restart="1 day")


@case(
    "trips",
    sql(
        f"""SELECT *, epoch_us(run_end) - epoch_us(run_start) AS duration_us FROM runs WHERE {TRIPS_WHERE}""",
        "snap", runs=sql_runs(),
    ),
)
def _(spark, sf):
    return t.trips(snap(spark, sf))


SLOT = "date_trunc('day', run_start)::TIMESTAMP + INTERVAL 1 HOUR * (hour(run_start) // 4 * 4)"
BUCKETS_SQL = f"""
    SELECT station_id, startTime, floor(minutes * 10 + 0.5::DOUBLE) / 10::DOUBLE AS travelTime
    FROM (SELECT station_id, {SLOT} AS startTime, {MINUTES} AS minutes FROM runs WHERE {TRIPS_WHERE} GROUP BY ALL)"""


@case("travel_by_bucket", sql(BUCKETS_SQL, "snap", runs=sql_runs("day")))
def travel_by_bucket(spark, sf):
    return t.travel_by_bucket(snap(spark, sf), START, END)


@case("travel_by_bucket_whole", sql(BUCKETS_SQL, "snap", runs=sql_runs()))
def _(spark, sf):
    """Trips over midnight are not cut."""
    return t.travel_by_bucket(snap(spark, sf), START, END, cut_days=False)


@case("travel_job", sql(BUCKETS_SQL, "snap", runs=sql_runs("day")))
def _(spark, sf):
    path = shared_dir(spark, "travel")
    travel_job(snap(spark, sf), START, END, path)
    return spark.read.parquet(path).select("station_id", "startTime", "travelTime")


BY_HOUR_SQL = sql(
    f"""SELECT station_id, startTime, CAST(coalesce(floor(minutes + 0.5::DOUBLE), 0) AS BIGINT) AS travelTime
        FROM spine LEFT JOIN (
            SELECT station_id, date_trunc('hour', run_start)::TIMESTAMP AS startTime, {MINUTES} AS minutes
            FROM runs WHERE {TRIPS_WHERE} GROUP BY ALL) USING (station_id, startTime)""",
    "snap routes", runs=sql_runs(), spine=sql_spine("HOUR"),
)


@case("travel_by_hour", BY_HOUR_SQL)
def travel_by_hour(spark, sf):
    return t.travel_by_hour(snap(spark, sf), routes(spark, sf), START, END)


@case(
    "chart_hourly_travel",
    sql(
        """SELECT '{"startTime":"' || strftime(startTime, '%H:%M') || ' - '
               || strftime(startTime + INTERVAL 1 HOUR, '%H:%M') || '","travelTime":' || travelTime || '}' AS json
           FROM hourly WHERE station_id = 3""",
        hourly=BY_HOUR_SQL,
    ),
)
def _(spark, sf):
    """The chart shows one route."""
    return charts.hourly_travel(snap(spark, sf), routes(spark, sf), 3, START, END)


@case(
    "merge_avg",
    sql(
        """SELECT station_id, CAST(sum(nbBikes) AS BIGINT) AS total, count(*) AS n,
                  sum(nbBikes) / count(*)::DOUBLE AS average FROM snap GROUP BY station_id""",
        "snap",
    ),
)
def _(spark, sf):
    rows = snap(spark, sf)
    sums = [F.sum("nbBikes").alias("total"), F.count("*").alias("n")]
    partials = rows.where("dirTag = 'out'").groupBy("station_id", "vehicle_id").agg(*sums).unionByName(
        rows.where("dirTag = 'in'").groupBy("station_id", "vehicle_id").agg(*sums)
    )
    return t.merge_avg(partials, ["station_id"], "total", "n")


def _sampled_ids_sql(width: str, order: str) -> str:
    return f"""
        SELECT station_id, startTime, vehicle_id FROM (
            SELECT DISTINCT station_id, time_bucket(INTERVAL {width}, dateTime, TIMESTAMP '2024-01-01') AS startTime,
                   vehicle_id FROM snap)
        QUALIFY row_number() OVER (PARTITION BY station_id, startTime ORDER BY {order}, vehicle_id) <= """


# A station has two vehicles, so one is a real limit.
FIRST_SQL = _sampled_ids_sql("4 HOUR", "vehicle_id") + "1"
HASHED_SQL = _sampled_ids_sql("1 HOUR", "md5('ids' || vehicle_id)") + "1"


@case("first_ids", sql(FIRST_SQL, "snap"))
def _(spark, sf):
    return t.first_ids(snap(spark, sf), START, END, n=1)


@case("sample_ids", sql(HASHED_SQL, "snap"))
def _(spark, sf):
    return t.sample_ids(snap(spark, sf), START, END, n=1)


def _both(spark, sf):
    rows = snap(spark, sf)
    return t.first_ids(rows, START, END, n=1).unionByName(t.sample_ids(rows, START, END, n=1))


@case("union_samples", sql(f"{FIRST_SQL} UNION ALL {HASHED_SQL}", "snap"))
def _(spark, sf):
    return _both(spark, sf)


@case(
    "distinct_samples",
    sql(
        "SELECT DISTINCT station_id, vehicle_id FROM (SELECT * FROM a UNION ALL SELECT * FROM b)",
        "snap", a=FIRST_SQL, b=HASHED_SQL,
    ),
)
def _(spark, sf):
    return rollup.distinct_ids(_both(spark, sf), ("station_id", "vehicle_id"))


@case(
    "keep_ids",
    sql(
        """SELECT event_id, station_id, vehicle_id FROM snap
           SEMI JOIN (SELECT station_id, vehicle_id FROM a WHERE hour(startTime) = 0) USING (station_id, vehicle_id)""",
        "snap", a=HASHED_SQL,
    ),
)
def _(spark, sf):
    rows = snap(spark, sf)
    ids = t.sample_ids(rows, START, END, n=1).where(F.hour("startTime") == 0)
    return t.keep_ids(rows, ids).select("event_id", "station_id", "vehicle_id")


@case(
    "travel_by_bucket_sampled",
    sql(
        f"SELECT * FROM ({BUCKETS_SQL})",
        "", all_snap=sql("SELECT * FROM snap", "snap"),
        ids=f"SELECT DISTINCT station_id, vehicle_id FROM ({FIRST_SQL.replace('FROM snap', 'FROM all_snap')})",
        snap="SELECT * FROM all_snap SEMI JOIN ids USING (station_id, vehicle_id)", runs=sql_runs("day"),
    ),
)
def _(spark, sf):
    rows = snap(spark, sf)
    return t.travel_by_bucket(rows, START, END, ids=t.first_ids(rows, START, END, n=1))


# Every user is a vehicle here, so a station has more than the three that are taken.
MANY = "SELECT * REPLACE (CAST(user_id AS INT) AS vehicle_id) FROM (SELECT s.*, e.user_id FROM snap s JOIN events e USING (event_id))"
FIRST_THREE_SQL = _sampled_ids_sql("7 DAY", "vehicle_id").replace("FROM snap", "FROM many") + "3"
HASHED_THREE_SQL = _sampled_ids_sql("1 DAY", "md5('ids' || vehicle_id)").replace("FROM snap", "FROM many") + "3"


def _many(spark, sf):
    users = table(spark, sf, "events").select("event_id", F.col("user_id").cast("int").alias("vehicle_id"))
    return snap(spark, sf).drop("vehicle_id").join(users, "event_id")


@case("first_ids_three", sql(FIRST_THREE_SQL, "snap", many=MANY))
def _(spark, sf):
    return t.first_ids(_many(spark, sf), START, END, width="7 days")


@case("sample_ids_three", sql(HASHED_THREE_SQL, "snap", many=MANY))
def _(spark, sf):
    return t.sample_ids(_many(spark, sf), START, END, width="1 day")


@case(
    "keep_ids_three",
    sql(
        """SELECT event_id, station_id, vehicle_id FROM many
           SEMI JOIN (SELECT station_id, vehicle_id FROM a WHERE day(startTime) = 8) USING (station_id, vehicle_id)""",
        "snap", many=MANY, a=HASHED_THREE_SQL,
    ),
)
def _(spark, sf):
    rows = _many(spark, sf)
    ids = t.sample_ids(rows, START, END, width="1 day").where(F.dayofmonth("startTime") == 8)
    return t.keep_ids(rows, ids).select("event_id", "station_id", "vehicle_id")


@case(
    "first_arrival",
    sql(
        """SELECT d.station_id, d.startTime, d.vehicle_id, d.departed, min(e.dateTime) AS arrived,
                  min(epoch_us(e.dateTime) - epoch_us(d.departed)) AS travel_us
           FROM (
               SELECT station_id, vehicle_id, dateTime AS departed,
                      time_bucket(INTERVAL 1 DAY, dateTime, TIMESTAMP '2024-01-01') AS startTime
               FROM leaving
               QUALIFY row_number() OVER (PARTITION BY station_id, startTime ORDER BY dateTime, event_id) = 1) d
           JOIN arriving e ON e.station_id = d.station_id AND e.vehicle_id = d.vehicle_id
                AND time_bucket(INTERVAL 1 DAY, e.dateTime, TIMESTAMP '2024-01-01') = d.startTime
                AND epoch_us(e.dateTime) - epoch_us(d.departed) > 480000000
           GROUP BY ALL""",
        "snap routes", leaving=sql_hits("start", "0.006"), arriving=sql_hits("end", "0.006"),
    ),
)
def first_arrival(spark, sf):
    return t.first_arrival(snap(spark, sf), routes(spark, sf), START, END, width="1 day", tol=0.006)


@case(
    "union_distinct",
    """SELECT n_name AS name, '' AS note FROM nation
       UNION SELECT c_mktsegment, o_orderpriority FROM customer JOIN orders ON o_custkey = c_custkey""",
)
def _(spark, sf):
    nations = table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.lit("").alias("note"))
    joined = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return rollup.union_distinct(nations, joined.select("c_mktsegment", "o_orderpriority"))
