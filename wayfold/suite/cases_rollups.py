"""Rollups, names, ordered rows, end points, keyed changes, EXISTS."""

from pyspark.sql import functions as F

from wayfold.operators import endpoints, metrics, rollup, visits
from wayfold.operators.trips import travel_by_bucket
from wayfold.plans import charts
from wayfold.sources import ledger
from wayfold.sources.writers import shared_dir
from wayfold.suite import cases_trips as ct
from wayfold.suite.registry import case
from wayfold.suite.views import (
    END, START, routes, snap, sql, sql_daily, sql_hits, sql_runs, stop_times, stops, table, trips,
)

FREQ = {"hits": sql_hits(), "fact": sql_daily()}
TRAVEL = {"runs": sql_runs("day"), "fact": ct.BUCKETS_SQL}
WEEK = ("2024-01-08", "2024-01-29")
WEEK_SQL = "startTime >= TIMESTAMP '2024-01-08' AND startTime < TIMESTAMP '2024-01-29'"

TOP_FREQ_SQL = f"""
    SELECT station_id, freq, station_id || ' ' || station_name AS name FROM (
        SELECT station_id, CAST(sum(freq) AS BIGINT) AS freq FROM fact WHERE {WEEK_SQL}
        GROUP BY station_id ORDER BY freq DESC, station_id LIMIT 10) JOIN routes USING (station_id)"""
TOP_TRAVEL_SQL = f"""
    SELECT station_id, CAST(trunc(m) AS INT) AS travelTime, station_id || ' ' || station_name AS name FROM (
        SELECT station_id, round(avg(travelTime), 6) AS m FROM fact WHERE {WEEK_SQL}
        GROUP BY station_id ORDER BY m DESC, station_id LIMIT 10) JOIN routes USING (station_id)"""


def _freq(spark, sf):
    return visits.daily_frequency(snap(spark, sf), routes(spark, sf), START, END)


def _travel(spark, sf):
    return travel_by_bucket(snap(spark, sf), START, END)


@case("frequency_top", sql(TOP_FREQ_SQL, "snap routes", **FREQ))
def frequency_top(spark, sf):
    return rollup.frequency_top(_freq(spark, sf), routes(spark, sf), *WEEK)


@case("travel_top", sql(TOP_TRAVEL_SQL, "snap routes", **TRAVEL))
def travel_top(spark, sf):
    return rollup.travel_top(_travel(spark, sf), routes(spark, sf), *WEEK)


@case(
    "chart_total_frequency",
    sql(
        """SELECT '{"station_id":"' || name || '","freq":' || freq || '}' AS json FROM top""",
        "snap routes", **FREQ, top=TOP_FREQ_SQL,
    ),
)
def _(spark, sf):
    return charts.total_frequency(_freq(spark, sf), routes(spark, sf), *WEEK)


@case(
    "chart_mean_travel",
    sql(
        """SELECT '{"station_id":"' || name || '","travelTime":' || travelTime || '}' AS json FROM top""",
        "snap routes", **TRAVEL, top=TOP_TRAVEL_SQL,
    ),
)
def _(spark, sf):
    return charts.mean_travel(_travel(spark, sf), routes(spark, sf), *WEEK)


@case(
    "with_names",
    sql(
        """SELECT station_id, startTime, freq,
                  station_id || CASE WHEN station_name IS NULL THEN '' ELSE ' ' || station_name END AS name
           FROM fact LEFT JOIN (SELECT * FROM routes WHERE station_name NOT LIKE '%7') USING (station_id)""",
        "snap routes", **FREQ,
    ),
)
def _(spark, sf):
    """Two stations have no name here."""
    named = routes(spark, sf).where("station_name NOT LIKE '%7'")
    return rollup.with_names(_freq(spark, sf), named)


@case("display_name", "SELECT c_custkey, c_custkey || ' ' || c_name AS name FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", rollup.display_name(F.col("c_custkey"), F.col("c_name")).alias("name")
    )


@case("route_list", sql('SELECT station_id, station_name AS "routeName" FROM routes', "routes"))
def _(spark, sf):
    return rollup.route_list(routes(spark, sf))


@case(
    "chart_route_list",
    sql(
        """SELECT '{"station_id":' || station_id || ',"routeName":"' || station_name || '"}' AS json FROM routes""",
        "routes",
    ),
)
def _(spark, sf):
    return charts.routes_shown(routes(spark, sf))


@case(
    "nth_row",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderkey LIMIT 1 OFFSET 123",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rollup.nth_row(orders, ["o_custkey", "o_orderkey"], 123)


@case(
    "cap_rows",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 500""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rollup.cap_rows(orders, [F.desc("o_totalprice"), "o_orderkey"], 500)


ITEMS = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax")
_HALF = "(SELECT count(*) // 2 FROM lineitem)"


@case("nth_row_far", f"SELECT {', '.join(ITEMS)} FROM lineitem ORDER BY {', '.join(ITEMS)} LIMIT 1 OFFSET {_HALF}")
def _(spark, sf):
    """The line item in the middle."""
    items = table(spark, sf, "lineitem").select(*ITEMS)
    return rollup.nth_row(items, ITEMS, items.count() // 2, far=0)


@case(
    "cap_rows_far",
    f"""SELECT l_shipdate, count(*) AS items, CAST(sum(l_orderkey) AS BIGINT) AS keys
        FROM (SELECT {', '.join(ITEMS)} FROM lineitem ORDER BY l_shipdate DESC, {', '.join(ITEMS[1:])} LIMIT {_HALF})
        GROUP BY l_shipdate""",
)
def _(spark, sf):
    """The newer half of all line items, by day."""
    items = table(spark, sf, "lineitem").select(*ITEMS)
    half = rollup.cap_rows(items, [F.desc("l_shipdate"), *ITEMS[1:]], items.count() // 2, far=0)
    return half.groupBy("l_shipdate").agg(F.count("*").alias("items"), F.sum("l_orderkey").alias("keys"))


ENDPOINTS_SQL = """
    SELECT station_id, s.stop_lat AS start_lat, CAST(s.stop_lon AS DOUBLE) AS start_lon,
           e.stop_lat AS end_lat, CAST(e.stop_lon AS DOUBLE) AS end_lon
    FROM (SELECT station_id, min(trip_id) AS first_trip, max(trip_id) AS last_trip FROM trips GROUP BY station_id)
    LEFT JOIN (SELECT trip_id AS first_trip, stop_id AS first_stop FROM stop_times
               QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY stop_sequence, stop_id) = 1) USING (first_trip)
    LEFT JOIN (SELECT trip_id AS last_trip, stop_id AS last_stop FROM stop_times
               QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY stop_sequence DESC, stop_id DESC) = 1)
        USING (last_trip)
    LEFT JOIN stops s ON s.stop_id = first_stop LEFT JOIN stops e ON e.stop_id = last_stop"""


def _endpoints(spark, sf):
    return endpoints.route_endpoints(trips(spark, sf), stop_times(spark, sf), stops(spark, sf))


@case("route_endpoints", sql(ENDPOINTS_SQL, "trips stop_times stops"))
def route_endpoints(spark, sf):
    return _endpoints(spark, sf)


@case(
    "update_endpoints",
    sql(
        """SELECT c_custkey AS station_id, c_name AS station_name,
                  coalesce(f.start_lat, c_acctbal) AS start_lat, coalesce(f.start_lon, -1.0::DOUBLE) AS start_lon,
                  coalesce(f.end_lat, c_acctbal) AS end_lat, coalesce(f.end_lon, -1.0::DOUBLE) AS end_lon
           FROM customer LEFT JOIN found f ON f.station_id = c_custkey""",
        "trips stop_times stops", found=ENDPOINTS_SQL,
    ),
)
def _(spark, sf):
    old = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("station_id"), F.col("c_name").alias("station_name"),
        F.col("c_acctbal").alias("start_lat"), F.lit(-1.0).alias("start_lon"),
        F.col("c_acctbal").alias("end_lat"), F.lit(-1.0).alias("end_lon"),
    )
    return endpoints.update_endpoints(old, _endpoints(spark, sf))


CHANGES_SQL = """WITH changes AS (
           SELECT l_orderkey + CASE WHEN l_returnflag = 'A' THEN 1000000 ELSE 0 END AS o_orderkey, l_extendedprice,
                  CASE WHEN l_returnflag = 'R' THEN 'delete' ELSE 'update' END AS op, l_shipdate, l_partkey, l_suppkey,
                  l_linenumber
           FROM lineitem),
       last AS (SELECT * FROM changes
                QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY l_shipdate DESC, l_partkey DESC,
                                           l_suppkey DESC, l_linenumber DESC, l_extendedprice DESC) = 1)
       SELECT coalesce(o.o_orderkey, c.o_orderkey) AS o_orderkey,
              CASE WHEN c.op IS NULL THEN o_totalprice ELSE l_extendedprice END AS o_totalprice
       FROM orders o FULL JOIN last c ON c.o_orderkey = o.o_orderkey WHERE op IS DISTINCT FROM 'delete'"""


def _item_changes(spark, sf):
    """Line items as changes of their order: updates, deletes, and inserts under new keys."""
    shift = F.when(F.col("l_returnflag") == "A", 1000000).otherwise(0)
    changes = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") + shift).alias("o_orderkey"),
        F.col("l_extendedprice").alias("o_totalprice"),
        F.when(F.col("l_returnflag") == "R", "delete").otherwise("update").alias("op"),
        "l_shipdate", "l_partkey", "l_suppkey", "l_linenumber",
    )
    return changes, ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "o_totalprice"]


@case(
    "apply_changes",
    CHANGES_SQL,
)
def apply_changes(spark, sf):
    base = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    changes, order = _item_changes(spark, sf)
    return endpoints.apply_changes(base, changes, ["o_orderkey"], "op", order)


@case("merge_published", CHANGES_SQL)
def _(spark, sf):
    """The same changes merged into a stored table in parts, of which some hold no changed key."""
    base = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    path = shared_dir(spark, "orders")
    part = F.concat(F.lit("p"), F.floor(F.col("o_orderkey") / 4000))
    ledger.publish(base, path, part, [r[0] for r in base.select(part).distinct().collect()])
    changes, order = _item_changes(spark, sf)
    ledger.merge(spark, path, changes.where("o_orderkey < 8000"), ["o_orderkey"], "op", order, part)
    ledger.merge(spark, path, changes.where("o_orderkey >= 8000"), ["o_orderkey"], "op", order, part)
    return ledger.read_parts(spark, path).drop("part")


def _exists(spark, sf, statement):
    names = ("orders", "customer", "nation", "lineitem")
    return spark.sql(statement, **{name: table(spark, sf, name) for name in names})


EXISTS = {
    "exists_correlated": """
        SELECT o_orderkey, c_name FROM {orders}, {customer}
        WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT'
          AND EXISTS (SELECT 'X' FROM {lineitem} WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""",
    "exists_uncorrelated": """
        SELECT o_orderkey, c_name FROM {orders}, {customer}
        WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT'
          AND EXISTS (SELECT 'X' FROM {nation} WHERE n_nationkey = 2)""",
    "exists_single": """
        SELECT c_custkey, c_name FROM {customer}
        WHERE c_mktsegment = 'MACHINERY' AND EXISTS (SELECT 'X' FROM {orders} WHERE o_custkey = c_custkey)""",
    "exists_over_join": """
        SELECT c_name FROM {customer}, {orders}
        WHERE o_custkey = c_custkey AND EXISTS (SELECT 'X' FROM {lineitem} WHERE l_orderkey = o_orderkey)""",
}


def _register_exists(name, statement):
    bare = statement.replace("{", "").replace("}", "")

    @case(name, bare)
    def _(spark, sf):
        return _exists(spark, sf, statement)


for _name, _statement in EXISTS.items():
    _register_exists(_name, _statement)


@case(
    "numeric_diff",
    """WITH readings AS (
           SELECT user_id, max_by(value, ts) FILTER (ts < TIMESTAMP '2024-01-16') AS before, max_by(value, ts) AS after,
                  max_by(event_type, ts) AS kind
           FROM events GROUP BY user_id)
       SELECT user_id, after - before AS change FROM readings
       WHERE before IS NOT NULL AND kind <> 'error' AND after <> before""",
)
def _(spark, sf):
    """Last reading of each user at two times, as text; users last seen in error have no number."""
    events = table(spark, sf, "events")
    kind = events.groupBy("user_id").agg(F.max_by("event_type", "ts").alias("kind"))
    value = F.max_by("value", "ts").cast("string")
    before = events.where("ts < TIMESTAMP_NTZ '2024-01-16 00:00:00'").groupBy("user_id").agg(value.alias("val"))
    after = events.groupBy("user_id").agg(value.alias("val")).join(kind, "user_id")
    after = after.withColumn("val", F.when(F.col("kind") == "error", "n/a").otherwise(F.col("val")))
    return metrics.numeric_diff(before, after, "user_id", "val")
