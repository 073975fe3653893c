"""Hourly records and visits over a stream of snapshots.

Both append a row once the watermark has passed the end of its window or session. Event time must
be a timestamp with zone; a column without zone is cast, so keep the session zone at UTC.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from wayfold.operators.geo import PREC, TOL, scaled, snap_in_box
from wayfold.operators.spine import DAY
from wayfold.operators.visits import HOUR, VISIT_GAP
from wayfold.plans.timing import MICRO, as_delta

MERGE_EARLY = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def _text(width: str | timedelta) -> str:
    return f"{as_delta(width) // MICRO} microseconds"


def _start_hits(
    stream: DataFrame, routes: DataFrame, delay: str | timedelta, prec: int, tol: float
) -> DataFrame:
    timed = stream.withColumn("dateTime", F.col("dateTime").cast("timestamp"))
    return snap_in_box(timed.withWatermark("dateTime", _text(delay)), routes, "start", prec, tol)


def stream_hourly_records(
    stream: DataFrame, routes: DataFrame, delay: str | timedelta = HOUR,
    width: str | timedelta = HOUR, prec: int = PREC, tol: float = TOL,
) -> DataFrame:
    """Records in the start box per route and window."""
    hits = _start_hits(stream, routes, delay, prec, tol)
    counts = hits.groupBy(F.window("dateTime", _text(width)), "station_id").agg(F.count("*").alias("freq"))
    return counts.select("station_id", F.col("window.start").alias("startTime"), "freq")


def stream_visits(
    stream: DataFrame, routes: DataFrame, gap: str | timedelta = VISIT_GAP,
    delay: str | timedelta = HOUR, prec: int = PREC, tol: float = TOL,
) -> DataFrame:
    """Visits in the start box per route and vehicle.

    With the setting that :func:`run_available` starts its query with, records are merged into sessions in
    the task that read them, before the shuffle, so a hot vehicle costs a few rows per task.
    """
    hits = _start_hits(stream, routes, delay, prec, tol)
    sessions = hits.groupBy(
        F.session_window("dateTime", _text(gap)), "station_id", "vehicle_id"
    ).agg(
        F.min("dateTime").alias("visit_start"),
        F.max("dateTime").alias("visit_end"),
        F.count("*").alias("records"),
    )
    return sessions.select("station_id", "vehicle_id", "visit_start", "visit_end", "records")


def stream_daily_visits(
    stream: DataFrame, routes: DataFrame, gap: str | timedelta = VISIT_GAP,
    delay: str | timedelta = HOUR, prec: int = PREC, tol: float = TOL, scale: bool = True,
) -> DataFrame:
    """Visits in the start box per route and day, divided by the loop factor: the stream's ``daily_frequency``.

    Two chained states under one watermark: sessions, cut at midnight as in the batch, and the count of the sessions that
    have closed. A day's last session may close up to ``gap`` after midnight, so the days of the second state are
    windows that begin that much later: every session of a day, and no other, closes inside its window. A day is appended
    once, when the watermark has passed its end and the gap.
    """
    hits = _start_hits(stream, routes, delay, prec, tol).withColumn("day", F.date_trunc("day", "dateTime"))
    sessions = hits.groupBy(F.session_window("dateTime", _text(gap)), "station_id", "vehicle_id", "factor", "day").agg(F.count("*").alias("records"))
    # The time of a closed session is its last record and the gap, less a microsecond.
    late = (as_delta(gap) - MICRO) % DAY
    closed = F.window(F.window_time("session_window"), _text(DAY), _text(DAY), _text(late))
    days = sessions.groupBy(closed, "station_id", "factor", "day").agg(F.count("*").alias("visits"))
    freq = scaled(F.col("visits"), F.col("factor")) if scale else F.col("visits")
    return days.select("station_id", F.col("day").alias("startTime"), freq.alias("freq"))


def run_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived, append it to Parquet files under ``path``, and stop.

    A query keeps the settings it was started with, so early merging of sessions is on for it alone; the caller's session
    has its own setting back at once.
    """
    conf = stream.sparkSession.conf
    before = conf.get(MERGE_EARLY)
    conf.set(MERGE_EARLY, "true")
    try:
        query = (
            stream.writeStream.outputMode("append")
            .format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        conf.set(MERGE_EARLY, before)
    query.awaitTermination()
    return query
