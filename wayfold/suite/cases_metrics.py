"""Durations."""

from pyspark.sql import functions as F

from wayfold.operators import metrics
from wayfold.sources import ledger
from wayfold.sources.writers import shared_dir
from wayfold.suite.registry import case
from wayfold.suite.views import END, START, snap, sql, table


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@case(
    "duration_summary",
    """SELECT event_type, max(value) AS longest, min(value) AS shortest, round(avg(value), 6) AS average,
              count(value) AS count FROM events GROUP BY event_type""",
)
def _(spark, sf):
    return _rounded(metrics.duration_summary(table(spark, sf, "events"), "value", ["event_type"]), "average")


def _histogram_sql(table_name: str, value: str, by: str = "") -> str:
    key, using = (f"{by}, ", f"{by}, ") if by else ("", "")
    group = f"GROUP BY {by}" if by else ""
    join = f"USING ({by})" if by else "ON true"
    partition = f"PARTITION BY {by}" if by else ""
    return f"""
        WITH bounds AS (
            SELECT {key}CAST(min({value}) AS DOUBLE) AS lo,
                   greatest(1.0::DOUBLE, (CAST(max({value}) AS DOUBLE) - CAST(min({value}) AS DOUBLE)) / 20::DOUBLE
                                         * 1.25::DOUBLE) AS w
            FROM {table_name} {group}),
        counts AS (
            SELECT {key}CAST(least(ceil((CAST({value} AS DOUBLE) - lo) / w), 19) AS INT) AS bucket, count(*) AS n
            FROM {table_name} JOIN bounds {join} GROUP BY ALL),
        filled AS (
            SELECT {key}bucket, lo + bucket * w AS breakpoint, coalesce(n, 0) AS count
            FROM (SELECT *, CAST(unnest(range(20)) AS INT) AS bucket FROM bounds)
            LEFT JOIN counts USING ({using}bucket))
        SELECT *, repeat('*', CAST(floor(20::DOUBLE * (count / greatest(max(count) OVER ({partition}), 1)::DOUBLE))
                                   AS INT)) AS bar
        FROM filled"""


@case("histogram", _histogram_sql("events", "value"))
def _(spark, sf):
    return metrics.histogram20(table(spark, sf, "events"), "value")


@case("histogram_by_type", _histogram_sql("events", "value", "event_type"))
def histogram_by_type(spark, sf):
    return metrics.histogram20(table(spark, sf, "events"), "value", ["event_type"])


@case(
    "histogram_of_counts",
    _histogram_sql("(SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey)", "n_orders"),
)
def _(spark, sf):
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    return metrics.histogram20(counts, "n_orders")


# Added before rounding, as means and margins of short decimals often end right on a rounding edge.
SHIFT = 1.23e-8


def _margin_sql(level: int) -> str:
    values = ", ".join(f"{t}::DOUBLE" for t in metrics.T_TABLE[level])
    return f"""
        SELECT user_id, day, n, round(mean + {SHIFT}, 6) AS mean, round(sd + {SHIFT}, 6) AS stdevp,
               round(t * (sd / sqrt(n)) + {SHIFT}, 6) AS margin,
               CASE WHEN n > 1 THEN round(0.1::DOUBLE - 2 * t * sd / sqrt(n - 1) / mean + {SHIFT}, 6) END AS confidence
        FROM (SELECT *, CASE WHEN n <= 30 THEN ([{values}])[n] END AS t FROM (
            SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, avg(value) AS mean, stddev_pop(value) AS sd
            FROM events GROUP BY ALL))"""


def _margin(spark, sf, level):
    daily = table(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    found = metrics.margin_of_error(daily, "value", ["user_id", "day"], level)
    names = ("mean", "stdevp", "margin", "confidence")
    return found.withColumns({c: F.round(F.col(c) + F.lit(SHIFT), 6) for c in names})


@case("margin_of_error_95", _margin_sql(95))
def _(spark, sf):
    return _margin(spark, sf, 95)


@case("margin_of_error_99", _margin_sql(99))
def _(spark, sf):
    return _margin(spark, sf, 99)


_Z = metrics.NORMAL[95]


@case(
    "margin_of_error_large",
    f"""SELECT event_type, n, round(mean, 6) AS mean, round(sd, 6) AS stdevp,
               round(({_Z} + ({_Z}::DOUBLE ** 3 + {_Z}) / (4 * n) + (5 * {_Z}::DOUBLE ** 5 + 16 * {_Z}::DOUBLE ** 3 + 3 * {_Z}) / (96.0 * n * n)) * sd / sqrt(n), 6) AS margin
        FROM (SELECT event_type, count(*) AS n, avg(value) AS mean, stddev_pop(value) AS sd FROM events GROUP BY ALL)""",
)
def _(spark, sf):
    """Groups of far more runs than the table has."""
    found = metrics.margin_of_error(table(spark, sf, "events"), "value", ["event_type"])
    return _rounded(found, "mean", "stdevp", "margin").drop("confidence")


MONTH = ("2024-01-05", "2024-01-25")
_MONTH_SQL = "FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25' GROUP BY event_type"


def _daily_moments(spark, sf):
    """Moments of the event types kept by day, and the days of the range merged."""
    events = table(spark, sf, "events").withColumn("startTime", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    path = shared_dir(spark, "moments")
    ledger.publish_days(metrics.moments(events, "value", ["event_type", "startTime"]), path, START, END)
    return metrics.merge_moments(ledger.read_published(spark, path, *MONTH), ["event_type"])


@case(
    "summary_of_days",
    f"""SELECT event_type, max(value) AS longest, min(value) AS shortest, round(avg(value), 6) AS average,
               count(value) AS count {_MONTH_SQL}""",
)
def _(spark, sf):
    return _rounded(metrics.summary_of(_daily_moments(spark, sf), ["event_type"]), "average")


@case(
    "margin_of_days",
    f"""SELECT event_type, n, round(mean, 6) AS mean, round(sd, 6) AS stdevp,
               round(({_Z} + ({_Z}::DOUBLE ** 3 + {_Z}) / (4 * n) + (5 * {_Z}::DOUBLE ** 5 + 16 * {_Z}::DOUBLE ** 3 + 3 * {_Z}) / (96.0 * n * n)) * sd / sqrt(n), 6) AS margin
        FROM (SELECT event_type, count(*) AS n, avg(value) AS mean, stddev_pop(value) AS sd {_MONTH_SQL}) WHERE n > 30""",
)
def _(spark, sf):
    found = metrics.margin_of(_daily_moments(spark, sf), ["event_type"]).where("n > 30")
    return _rounded(found, "mean", "stdevp", "margin").drop("confidence")


@case(
    "throughput",
    """SELECT event_type, count(*) AS queries, CAST(sum(k) AS BIGINT) AS rows,
              round(count(*) / (span / 1e6::DOUBLE), 6) AS queries_per_s, round(sum(k) / (span / 1e6::DOUBLE), 6) AS rows_per_s,
              round(busy / count(*)::DOUBLE / 1e6::DOUBLE, 6) AS mean_s
       FROM (SELECT *, max(epoch_us(ts) + us) OVER w - min(epoch_us(ts)) OVER w AS span, sum(us) OVER w AS busy
             FROM (SELECT *, CAST(round(value * 1000000) AS BIGINT) AS us,
                          CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)
             WINDOW w AS (PARTITION BY event_type))
       GROUP BY event_type, span, busy""",
)
def _(spark, sf):
    events = table(spark, sf, "events").select(
        "event_type", "ts", F.get_json_object("props", "$.k").cast("int").alias("k"),
        (F.col("ts") + F.make_dt_interval(secs=F.col("value").cast("decimal(18,6)"))).alias("ended"),
    )
    found = metrics.throughput(events, "ts", "ended", "k", ["event_type"])
    return _rounded(found, "queries_per_s", "rows_per_s", "mean_s")


@case("slow", "SELECT event_id, value FROM events WHERE value > 250")
def _(spark, sf):
    return metrics.slow(table(spark, sf, "events").select("event_id", "value"), "value", 250)


@case(
    "abnormal",
    sql(
        """SELECT event_id, station_id, dateTime, value FROM (
               SELECT *, count(*) OVER w AS n, avg(value) OVER w AS m, stddev_samp(value) OVER w AS s FROM snap
               WINDOW w AS (PARTITION BY station_id ORDER BY dateTime, event_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
           WHERE n >= 15 AND value > m + 5 * s""",
        "snap",
    ),
)
def abnormal(spark, sf):
    rows = snap(spark, sf).select("event_id", "station_id", "dateTime", "value")
    return metrics.abnormal(rows, ["station_id"], ["dateTime", "event_id"], "value")
