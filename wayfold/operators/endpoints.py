"""Route end points from the stop hierarchy, and keyed changes to a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wayfold.plans.joins import join_dim

_COORDS = ("start_lat", "start_lon", "end_lat", "end_lon")


def route_endpoints(trips: DataFrame, stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """First stop of the first trip and last stop of the last trip of every route.

    Trips are ordered by id, stops of a trip by sequence, then stop id. A route whose trip has no
    stops keeps null coordinates. Stop times are read once and folded to one row per trip before
    the shuffle, so a trip with very many of them costs one row per task; the join on the trip then
    finds them partitioned already.
    """
    position = F.struct("stop_sequence", "stop_id")
    ends_of_trip = stop_times.groupBy("trip_id").agg(
        F.min(position)["stop_id"].alias("__first"), F.max(position)["stop_id"].alias("__last")
    )
    spans = trips.groupBy("station_id").agg(F.min("trip_id").alias("__lo"), F.max("trip_id").alias("__hi"))
    pairs = [F.struct(F.lit(end).alias("__end"), F.col(trip).alias("trip_id"))
             for end, trip in (("start", "__lo"), ("end", "__hi"))]
    ends = spans.select("station_id", F.inline(F.array(*pairs))).join(ends_of_trip, "trip_id", "left")
    ends = ends.withColumn(
        "stop_id", F.when(F.col("__end") == "start", F.col("__first")).otherwise(F.col("__last"))
    )
    placed = join_dim(ends, stops.select("stop_id", "stop_lat", "stop_lon"), "stop_id", "left")

    def coord(name: str) -> Column:
        end, axis = name.split("_")
        found = F.when(F.col("__end") == end, F.col(f"stop_{axis}").cast("double"))
        return F.max(found).alias(name)

    return placed.groupBy("station_id").agg(*[coord(c) for c in _COORDS])


def update_endpoints(routes: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Routes with the coordinates found for them; those without keep their own."""
    found = endpoints.select("station_id", *[F.col(c).alias(f"__{c}") for c in _COORDS])
    joined = routes.join(found, "station_id", "left")
    return joined.withColumns({c: F.coalesce(F.col(f"__{c}"), F.col(c)) for c in _COORDS}).select(
        *routes.columns
    )


def apply_changes(
    base: DataFrame, changes: DataFrame, keys: Sequence[str], op_col: str,
    order: Sequence[str | Column],
) -> DataFrame:
    """``base`` after keyed changes; ``op_col`` says ``insert``, ``update`` or ``delete``.

    The last change of a key in ``order`` wins. It is found with an aggregate, so many changes of one key are folded before
    the shuffle. Rows whose key is not changed pass an anti join, and the last changes are added to them: where
    the changed keys are few enough to be broadcast, the base is not shuffled at all, nor is one bucketed by its key.
    """
    missing = [k for k in keys if k not in base.columns or k not in changes.columns]
    if not keys or missing:
        raise ValueError(f"changes need the full primary key, missing: {missing or 'all'}")
    values = [c for c in base.columns if c not in keys]
    newest = F.max_by(F.struct(op_col, *[F.col(v).alias(f"__{v}") for v in values]), F.struct(*order))
    last = changes.groupBy(*keys).agg(newest.alias("__new"))
    same = base.join(last.select(*keys), list(keys), "left_anti")
    kinds = {f.name: f.dataType for f in base.schema.fields}
    made = last.where(F.col(f"__new.{op_col}") != "delete").select(
        *[F.col(k).cast(kinds[k]).alias(k) for k in keys], *[F.col(f"__new.__{v}").cast(kinds[v]).alias(v) for v in values]
    )
    return same.select(*base.columns).unionAll(made.select(*base.columns))
