"""Scans, sources, sinks, intervals."""

from pyspark.sql import functions as F, types as T

from wayfold import schemas
from wayfold.functions.time import hour_bucket, hour_start, interval_label, padded_hour, parse_ts
from wayfold.operators import spine, visits
from wayfold.operators.rollup import count_rows, distinct_ids
from wayfold.plans.jobs import frequency_job
from wayfold.sources import ledger, readers, writers
from wayfold.suite.registry import case
from wayfold.suite.views import (
    END, START, routes, snap, sql, sql_daily, sql_hits, sql_spine, table,
)

FROM, TO = "2024-01-05 06:00:00", "2024-01-25 18:00:00"
RANGE_SQL = f"dateTime >= TIMESTAMP '{FROM}' AND dateTime < TIMESTAMP '{TO}'"


@case("scan_range", sql(f"SELECT * FROM snap WHERE {RANGE_SQL}", "snap"))
def _(spark, sf):
    return readers.scan_range(snap(spark, sf), "dateTime", FROM, TO)


@case("scan_range_key", sql(f"SELECT * FROM snap WHERE {RANGE_SQL} AND station_id = 7", "snap"))
def _(spark, sf):
    """The operator is the scan of one key."""
    return readers.scan_range(snap(spark, sf), "dateTime", FROM, TO, "station_id", 7)


@case("scan_points", sql(f"SELECT lat, lon FROM snap WHERE {RANGE_SQL}", "snap"))
def _(spark, sf):
    return readers.scan_points(snap(spark, sf), FROM, TO)


@case("load_routes", sql("SELECT * FROM routes", "routes"))
def _(spark, sf):
    path = writers.shared_dir(spark, "routes")
    routes(spark, sf).write.parquet(path)
    return readers.load_routes(spark, path)


@case("route_start", sql("SELECT start_lat, start_lon FROM routes WHERE station_id = 7", "routes"))
def _(spark, sf):
    return readers.route_start(routes(spark, sf), 7)


@case(
    "read_json_records",
    "SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events",
)
def _(spark, sf):
    path = writers.shared_dir(spark, "records")
    events = table(spark, sf, "events").withColumn("at", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    events.drop("ts").write.json(path)
    schema = "event_id bigint, user_id bigint, event_type string, value double, props string, at string"
    return readers.read_json_records(spark, path, T.StructType.fromDDL(schema))


@case("load_delimited", "SELECT * FROM lineitem")
def _(spark, sf):
    path = writers.shared_dir(spark, "delimited")
    lines = table(spark, sf, "lineitem")
    lines.write.option("sep", "\t").option("nullValue", "\\N").csv(path)
    return readers.load_delimited(spark, path, lines.schema)


@case("append_fact", sql(sql_daily(), "snap routes", hits=sql_hits()))
def _(spark, sf):
    """The fact is written for all days, then again for a part of them."""
    path = writers.shared_dir(spark, "fact")
    facts = visits.daily_frequency(snap(spark, sf), routes(spark, sf), START, END)
    writers.append_fact(facts, path)
    writers.append_fact(readers.scan_range(facts, "startTime", "2024-01-10", "2024-01-20"), path)
    return spark.read.parquet(path).select("station_id", "startTime", "freq")


@case("publish_days", sql(sql_daily(), "snap routes", hits=sql_hits()))
def _(spark, sf):
    """Some days are published with wrong values and then again, and the days still open are filled by the week."""
    path = writers.shared_dir(spark, "published")
    facts = visits.daily_frequency(snap(spark, sf), routes(spark, sf), START, END)

    def compute(start, end):
        return readers.scan_range(facts, "startTime", start, end)

    ledger.publish_days(compute(START, "2024-01-20").withColumn("freq", -F.col("freq")), path, START, "2024-01-20")
    ledger.publish_days(compute(START, "2024-01-20"), path, START, "2024-01-20")
    ledger.fill_days(spark, path, START, END, compute, longest=7)
    return ledger.read_published(spark, path, START, END)


@case(
    "run_states",
    """SELECT o_orderdate::DATE AS day, arg_max(o_orderstatus, o_orderkey) AS state, max(o_orderkey) AS run
       FROM orders GROUP BY ALL""",
)
def _(spark, sf):
    """Orders as a log of runs: the newest state of each day."""
    log = table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderkey").alias("run"), F.col("o_orderstatus").alias("state")
    )
    return ledger.fold_states(log, "day", ["run"], ["state", "run"])


@case("read_days", sql(f"SELECT * FROM snap WHERE {RANGE_SQL}", "snap"))
def _(spark, sf):
    """Snapshots kept by day, and a range of them read back."""
    path = writers.shared_dir(spark, "snapshots")
    writers.append_fact(snap(spark, sf), path, "dateTime")
    return readers.read_days(spark, path, FROM, TO, "dateTime")


@case(
    "frequency_job",
    sql(
        """SELECT station_id, startTime, coalesce(freq, 0) AS freq
           FROM spine LEFT JOIN daily USING (station_id, startTime)""",
        "snap routes", hits=sql_hits(), daily=sql_daily(), spine=sql_spine("DAY"),
    ),
)
def _(spark, sf):
    path = writers.shared_dir(spark, "frequency")
    frequency_job(snap(spark, sf), routes(spark, sf), START, END, path)
    return spark.read.parquet(path).select("station_id", "startTime", "freq")


@case(
    "chart_json",
    sql(
        """SELECT '{"station_id":' || station_id || ',"startTime":"'
               || strftime(startTime, '%H:%M') || ' - ' || strftime(startTime + INTERVAL 1 HOUR, '%H:%M')
               || '","freq":' || coalesce(n, 0) || '}' AS json
           FROM spine LEFT JOIN (
               SELECT station_id, date_trunc('hour', dateTime)::TIMESTAMP AS startTime, count(*) AS n FROM hits
               GROUP BY ALL) USING (station_id, startTime)""",
        "snap routes", hits=sql_hits(), spine=sql_spine("HOUR"),
    ),
)
def _(spark, sf):
    counts = visits.hourly_records(snap(spark, sf), routes(spark, sf), START, END)
    counts = counts.withColumn("at", F.col("startTime")).withColumn(
        "startTime", interval_label(F.col("at"), "1 hour")
    )
    return writers.chart_json(counts, ["station_id", "startTime", "freq"], ["station_id", "at"])


@case("empty_relation", sql(sql_daily(), "snap routes", hits=sql_hits()))
def _(spark, sf):
    facts = visits.daily_frequency(snap(spark, sf), routes(spark, sf), START, END)
    return readers.empty(spark, schemas.FREQUENCY_FACT).unionByName(facts)


@case("count_rows", "SELECT count(*) AS rows FROM lineitem")
def _(spark, sf):
    return count_rows(table(spark, sf, "lineitem"))


@case("distinct_ids", sql("SELECT DISTINCT station_id, vehicle_id FROM snap", "snap"))
def _(spark, sf):
    return distinct_ids(snap(spark, sf), ("station_id", "vehicle_id"))


@case(
    "clamp_range",
    """SELECT l_orderkey, l_linenumber, l_suppkey,
              least(l_shipdate, o_orderdate + INTERVAL 24 HOUR) AS clamped
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    end = spine.clamp_end(F.col("o_orderdate"), F.col("l_shipdate"))
    return lines.join(orders, "l_orderkey").select("l_orderkey", "l_linenumber", "l_suppkey", end.alias("clamped"))


@case(
    "parse_ts",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS at FROM orders""",
)
def _(spark, sf):
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    broken = F.concat(text, F.lit(" "), F.col("o_orderpriority"))
    orders = table(spark, sf, "orders").withColumn(
        "text", F.when(F.col("o_orderstatus") == "P", broken).otherwise(text)
    )
    return orders.select("o_orderkey", parse_ts(F.col("text")).alias("at"))


@case(
    "time_buckets",
    """SELECT event_id,
              strftime(ts, '%H:%M') || ' - ' || strftime(ts + INTERVAL 60 MINUTE, '%H:%M') AS label,
              CAST(hour(ts) // 4 * 4 AS INT) AS bucket, date_trunc('hour', ts)::TIMESTAMP AS hour_start,
              strftime(ts, '%H') AS padded
       FROM events""",
)
def _(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id", interval_label(ts, "1 hour").alias("label"), hour_bucket(ts, 4).alias("bucket"),
        hour_start(ts).alias("hour_start"), padded_hour(ts).alias("padded"),
    )


@case(
    "anchored_window",
    sql(
        """SELECT event_id, b AS startTime, least(b + INTERVAL 7 HOUR, TIMESTAMP '2024-01-25 18:00:00') AS endTime
           FROM (SELECT event_id, time_bucket(INTERVAL 7 HOUR, dateTime, TIMESTAMP '2024-01-05 06:20:00') AS b
                 FROM snap WHERE dateTime >= TIMESTAMP '2024-01-05 06:20:00'
                   AND dateTime < TIMESTAMP '2024-01-25 18:00:00')""",
        "snap",
    ),
)
def _(spark, sf):
    start = "2024-01-05 06:20:00"
    rows = readers.scan_range(snap(spark, sf), "dateTime", start, TO)
    return spine.anchored_window(rows, "dateTime", start, TO, "7 hours").select(
        "event_id", "startTime", "endTime"
    )


@case(
    "zero_fill",
    sql(
        """SELECT station_id, startTime, coalesce(records, 0) AS records FROM spine LEFT JOIN (
               SELECT station_id, date_trunc('hour', dateTime)::TIMESTAMP AS startTime, count(*) AS records
               FROM snap GROUP BY ALL) USING (station_id, startTime)""",
        "snap routes", spine=sql_spine("HOUR"),
    ),
)
def _(spark, sf):
    counts = snap(spark, sf).groupBy("station_id", hour_start(F.col("dateTime")).alias("startTime")).agg(
        F.count("*").alias("records")
    )
    hours = spine.keyed_spine(routes(spark, sf).select("station_id"), START, END, "1 hour")
    return spine.zero_fill(counts, hours, ["station_id", "startTime"], ["records"])


@case(
    "full_intervals",
    """SELECT startTime, count(event_id) AS records
       FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 05:00:00', TIMESTAMP '2024-01-30 05:00:00',
                                           INTERVAL 1 DAY)) AS startTime) s
       LEFT JOIN events ON ts >= startTime AND ts < startTime + INTERVAL 1 DAY
       GROUP BY startTime HAVING startTime + INTERVAL 1 DAY <= TIMESTAMP '2024-01-31 04:59:00'""",
)
def _(spark, sf):
    first, last = "2024-01-01 05:00:00", "2024-01-31 04:59:00"
    days = spine.full_intervals(spark, first, last)
    events = spine.anchored_window(
        readers.scan_range(table(spark, sf, "events"), "ts", first, last), "ts", first, last, "1 day"
    )
    counts = events.groupBy("startTime").agg(F.count("*").alias("records"))
    return spine.zero_fill(counts, days, ["startTime"], ["records"])


@case(
    "previous_day",
    "SELECT event_id, date_trunc('day', ts)::TIMESTAMP - INTERVAL 1 DAY AS previous FROM events",
)
def _(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", spine.previous_day_of(F.col("ts")).alias("previous")
    )


@case(
    "trailing_days",
    """SELECT startTime, count(event_id) AS records
       FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-14', INTERVAL 1 DAY)) AS startTime)
       LEFT JOIN events ON date_trunc('day', ts) = startTime GROUP BY startTime""",
)
def _(spark, sf):
    days = spine.trailing_days(spark, "2024-01-15 09:30:00")
    events = table(spark, sf, "events").groupBy(F.col("ts").cast("date").cast("timestamp_ntz").alias("startTime"))
    return spine.zero_fill(events.agg(F.count("*").alias("records")), days, ["startTime"], ["records"])


@case(
    "missing_days",
    """SELECT startTime FROM (SELECT unnest(generate_series(TIMESTAMP '2023-12-20', TIMESTAMP '2024-02-09',
                                                            INTERVAL 1 DAY)) AS startTime)
       WHERE startTime NOT IN (SELECT date_trunc('day', ts)::TIMESTAMP FROM events WHERE value > 440)""",
)
def _(spark, sf):
    long = table(spark, sf, "events").where("value > 440").withColumnRenamed("ts", "startTime")
    return spine.missing_days(long, "2023-12-20", "2024-02-10")
