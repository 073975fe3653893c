"""Boxes, visits, frequencies, streams."""

from pyspark.sql import functions as F

from wayfold.operators import geo, visits
from wayfold.plans import charts
from wayfold.sources import ledger
from wayfold.sources.writers import shared_dir
from wayfold.streaming import counts as streams
from wayfold.suite.registry import case
from wayfold.suite.views import (
    END, START, TABLES, routes, snap, snap_of, sql, sql_box, sql_daily, sql_factor, sql_hits, sql_spine,
)

# The box and gap under which the given records group into few, long visits.
WIDE = {"tol": 0.006, "gap": "6 hours"}
SIX_HOURS_US = 21_600_000_000


@case(
    "in_box",
    sql(
        f"""SELECT event_id, {sql_box('lat', 'lon', 'start', '0.002')} AS inside
            FROM snap JOIN routes USING (station_id)""",
        "snap routes",
    ),
)
def _(spark, sf):
    joined = snap(spark, sf).join(routes(spark, sf), "station_id")
    inside = geo.in_box(F.col("lat"), F.col("lon"), F.col("start_lat"), F.col("start_lon"))
    return joined.select("event_id", inside.alias("inside"))


@case("loop_factor", sql(f"SELECT station_id, {sql_factor()} AS factor FROM routes", "routes"))
def _(spark, sf):
    return routes(spark, sf).select("station_id", geo.loop_factor().alias("factor"))


@case(
    "scaled_count",
    sql(
        f"""SELECT station_id, CAST(count(*) // max({sql_factor()}) AS BIGINT) AS freq
            FROM snap JOIN routes USING (station_id) GROUP BY station_id""",
        "snap routes",
    ),
)
def _(spark, sf):
    records = snap(spark, sf).groupBy("station_id").agg(F.count("*").alias("n"))
    factors = routes(spark, sf).select("station_id", geo.loop_factor().alias("factor"))
    return records.join(factors, "station_id").select(
        "station_id", geo.scaled(F.col("n"), F.col("factor")).alias("freq")
    )


@case("snap_at_start", sql("SELECT event_id, station_id, vehicle_id, factor FROM hits", "snap routes", hits=sql_hits()))
def _(spark, sf):
    return geo.snap_in_box(snap(spark, sf), routes(spark, sf)).select(
        "event_id", "station_id", "vehicle_id", "factor"
    )


@case(
    "visits",
    sql(
        f"""SELECT station_id, vehicle_id, min(dateTime) AS visit_start, max(dateTime) AS visit_end, count(*) AS records
            FROM (SELECT *, sum(opens) OVER (PARTITION BY station_id, vehicle_id ORDER BY dateTime, event_id) AS v
                  FROM (SELECT *, CASE WHEN coalesce(epoch_us(dateTime) - epoch_us(lag(dateTime) OVER w)
                                                     <= {SIX_HOURS_US}, false) THEN 0 ELSE 1 END AS opens
                        FROM hits
                        WINDOW w AS (PARTITION BY station_id, vehicle_id ORDER BY dateTime, event_id)))
            GROUP BY station_id, vehicle_id, v""",
        "snap routes", hits=sql_hits("start", "0.006"),
    ),
)
def _(spark, sf):
    hits = geo.snap_in_box(snap(spark, sf), routes(spark, sf), tol=0.006)
    return visits.visits(hits, ["station_id", "vehicle_id"], gap="6 hours")


@case("daily_frequency", sql(sql_daily(), "snap routes", hits=sql_hits()))
def daily_frequency(spark, sf):
    return visits.daily_frequency(snap(spark, sf), routes(spark, sf), START, END)


@case(
    "daily_frequency_wide",
    sql(sql_daily(gap_us=SIX_HOURS_US), "snap routes", hits=sql_hits("start", "0.006")),
)
def daily_frequency_wide(spark, sf):
    return visits.daily_frequency(snap(spark, sf), routes(spark, sf), START, END, **WIDE)


@case(
    "daily_frequency_filled",
    sql(
        """SELECT station_id, startTime, coalesce(freq, 0) AS freq
           FROM spine LEFT JOIN daily USING (station_id, startTime)""",
        "snap routes", hits=sql_hits(), daily=sql_daily(), spine=sql_spine("DAY"),
    ),
)
def _(spark, sf):
    return visits.daily_frequency(snap(spark, sf), routes(spark, sf), START, END, keep_empty=True)


@case(
    "weekly_frequency",
    sql(
        """SELECT station_id, startTime, coalesce(freq, 0) AS freq
           FROM spine LEFT JOIN daily USING (station_id, startTime)
           WHERE startTime BETWEEN TIMESTAMP '2024-01-15' AND TIMESTAMP '2024-01-21'""",
        "snap routes", hits=sql_hits("start", "0.006"), daily=sql_daily(gap_us=SIX_HOURS_US), spine=sql_spine("DAY"),
    ),
)
def _(spark, sf):
    return visits.weekly_frequency(snap(spark, sf), routes(spark, sf), "2024-01-22 14:00:00", **WIDE)


HOURLY_SQL = sql(
    """SELECT station_id, startTime, coalesce(n, 0) AS freq FROM spine LEFT JOIN (
           SELECT station_id, date_trunc('hour', dateTime)::TIMESTAMP AS startTime, count(*) AS n FROM hits
           GROUP BY ALL) USING (station_id, startTime)""",
    "snap routes", hits=sql_hits(), spine=sql_spine("HOUR"),
)


@case("hourly_records", HOURLY_SQL)
def hourly_records(spark, sf):
    return visits.hourly_records(snap(spark, sf), routes(spark, sf), START, END)


def _hourly_visits_sql(value: str) -> str:
    return sql(
        f"""SELECT station_id, startTime, CAST(coalesce({value}, 0) AS BIGINT) AS freq FROM spine LEFT JOIN (
               SELECT station_id, startTime, sum(opens) AS v FROM (
                   SELECT station_id, date_trunc('hour', dateTime)::TIMESTAMP AS startTime,
                          CASE WHEN coalesce(epoch_us(dateTime) - epoch_us(lag(dateTime) OVER w) <= 120000000, false)
                               THEN 0 ELSE 1 END AS opens
                   FROM hits
                   WINDOW w AS (PARTITION BY station_id, vehicle_id, date_trunc('hour', dateTime) ORDER BY dateTime))
               GROUP BY station_id, startTime) USING (station_id, startTime)""",
        "snap routes", hits=sql_hits("start", "0.006"), spine=sql_spine("HOUR"),
    )


@case("hourly_visits", _hourly_visits_sql("v"))
def _(spark, sf):
    return visits.hourly_visits(snap(spark, sf), routes(spark, sf), START, END, tol=0.006)


@case("hourly_visits_without_first", _hourly_visits_sql("v - 1"))
def _(spark, sf):
    return visits.hourly_visits(
        snap(spark, sf), routes(spark, sf), START, END, tol=0.006, count_first=False
    )


@case(
    "chart_hourly_frequency",
    sql(
        f"""SELECT '{{"startTime":"' || strftime(startTime, '%H:%M') || ' - '
                || strftime(startTime + INTERVAL 1 HOUR, '%H:%M') || '","freq":' || freq || '}}' AS json
            FROM hourly WHERE station_id = 3""",
        hourly=HOURLY_SQL,
    ),
)
def _(spark, sf):
    """The chart shows one route."""
    return charts.hourly_frequency(snap(spark, sf), routes(spark, sf), 3, START, END)


def _stream(spark, sf):
    """The snapshots as a stream of files of the given events."""
    files = spark.readStream.schema(TABLES["events"]).option("pathGlobFilter", "events.parquet")
    return snap_of(files.parquet(sf))


def _drained(spark, stream, times):
    """Run the stream over what there is and read back its output."""
    path = shared_dir(spark, "stream")
    streams.run_available(stream, f"{path}/out", f"{path}/checkpoint")
    rows = spark.read.schema(stream.schema).parquet(f"{path}/out")
    return rows.withColumns({t: F.col(t).cast("timestamp_ntz") for t in times})


@case(
    "stream_hourly_records",
    sql(
        """SELECT station_id, date_trunc('hour', dateTime)::TIMESTAMP AS startTime, count(*) AS freq FROM hits
           GROUP BY station_id, date_trunc('hour', dateTime)
           HAVING date_trunc('hour', dateTime) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
        "snap routes", hits=sql_hits(),
    ),
)
def _(spark, sf):
    """Only the windows the watermark has closed."""
    rows = streams.stream_hourly_records(_stream(spark, sf), routes(spark, sf))
    return _drained(spark, rows, ["startTime"])


@case(
    "stream_visits",
    sql(
        f"""SELECT station_id, vehicle_id, min(dateTime) AS visit_start, max(dateTime) AS visit_end, count(*) AS records
            FROM (SELECT *, sum(opens) OVER (PARTITION BY station_id, vehicle_id ORDER BY dateTime, event_id) AS v
                  FROM (SELECT *, CASE WHEN coalesce(epoch_us(dateTime) - epoch_us(lag(dateTime) OVER w)
                                                     <= 900000000, false) THEN 0 ELSE 1 END AS opens
                        FROM hits
                        WINDOW w AS (PARTITION BY station_id, vehicle_id ORDER BY dateTime, event_id)))
            GROUP BY station_id, vehicle_id, v
            HAVING max(dateTime) + INTERVAL 15 MINUTE <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
        "snap routes", hits=sql_hits("start", "0.006"),
    ),
)
def _(spark, sf):
    """Only the sessions the watermark has closed."""
    rows = streams.stream_visits(_stream(spark, sf), routes(spark, sf), tol=0.006)
    return _drained(spark, rows, ["visit_start", "visit_end"])


@case(
    "stream_daily_visits",
    sql(
        """SELECT * FROM daily
           WHERE startTime + INTERVAL 1 DAY + INTERVAL 15 MINUTE <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
        "snap routes", hits=sql_hits("start", "0.006"), daily=sql_daily("0.006"),
    ),
)
def _(spark, sf):
    """Only the days the watermark has closed."""
    rows = streams.stream_daily_visits(_stream(spark, sf), routes(spark, sf), tol=0.006)
    return _drained(spark, rows, ["startTime"])


@case(
    "snap_near_routes",
    sql("SELECT event_id, station_id, vehicle_id, dateTime, lat, lon FROM hits", "snap routes", hits=sql_hits()),
)
def _(spark, sf):
    """Snapshots kept by day along a space-filling curve; the envelope of all boxes skips what is far from them."""
    path, kept = shared_dir(spark, "near"), snap(spark, sf).select("event_id", "station_id", "vehicle_id", "dateTime", "lat", "lon")
    ledger.publish_days(kept, path, START, END, "dateTime", near=geo.morton(F.col("lat"), F.col("lon")))
    stops = routes(spark, sf)
    rows = geo.in_envelope(ledger.read_published(spark, path, START, END, "dateTime"), geo.box_envelope(stops))
    return geo.snap_in_box(rows, stops).select(*kept.columns)
