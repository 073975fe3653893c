"""Small frames for tests."""

from __future__ import annotations

from datetime import datetime, timedelta

from wayfold import schemas

DAY0 = datetime(2024, 1, 1)

ROUTE = {
    "station_id": 1, "station_name": "One", "start_lat": 43.6, "start_lon": -79.4,
    "end_lat": 43.7, "end_lon": -79.4,
}
LOOP = ROUTE | {"station_id": 2, "station_name": "Two", "end_lat": 43.601}


def at(text: str) -> datetime:
    """``"03:50"`` or ``"03:50:01"`` on the first day, ``"2 03:50"`` two days later."""
    day, _, clock = text.rpartition(" ")
    hours, minutes, *rest = (int(x) for x in clock.split(":"))
    return DAY0 + timedelta(days=int(day or 0), hours=hours, minutes=minutes, seconds=rest[0] if rest else 0)


def snapshots(spark, rows):
    """Rows of (time, overrides); times as in :func:`at`."""
    base = {
        "station_id": 1, "vehicle_id": 1, "nbBikes": 0, "dirTag": "out", "lat": 43.6, "lon": -79.4, "value": 1.0,
    }
    full = [
        base | {"event_id": i, "dateTime": at(t) if isinstance(t, str) else t} | dict(over)
        for i, (t, over) in enumerate(rows)
    ]
    names = schemas.SNAPSHOTS.fieldNames()
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], schemas.SNAPSHOTS)


def routes(spark, *rows):
    names = schemas.ROUTES.fieldNames()
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows or (ROUTE,)], schemas.ROUTES)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
