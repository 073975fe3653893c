"""Dense areas: counts per grid cell, the largest cells, and neighbouring cells merged."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from wayfold.operators.geo import grid_units
from wayfold.operators.sampling import hash_sample
from wayfold.sources.writers import written

# Decimals of a cell, merge distance in degrees, areas reported.
CELL_PREC = 4
MERGE_TOL = 0.002
AREAS = 20

_AREA = "struct<lat:bigint,lon:bigint,count:bigint>"


def cell_counts(points: DataFrame, prec: int = CELL_PREC) -> DataFrame:
    """Records per (lat, lon) cell."""
    step = F.lit(float(10**prec))
    return (
        _cells(points, prec)
        .select((F.col("lat") / step).alias("lat"), (F.col("lon") / step).alias("lon"), "count")
    )


def _cells(points: DataFrame, prec: int) -> DataFrame:
    lat, lon = grid_units(F.col("lat"), prec), grid_units(F.col("lon"), prec)
    return points.groupBy(lat.alias("lat"), lon.alias("lon")).agg(F.count("*").alias("count"))


def top_cells(cells: DataFrame, n: int = 2 * AREAS) -> DataFrame:
    """The ``n`` largest cells, in (lat, lon) order; equal counts by lat, then lon."""
    return cells.orderBy(F.desc("count"), "lat", "lon").limit(n).orderBy("lat", "lon")


def _merge(areas: Column, cell: Column, n: int, reach: float) -> Column:
    """Add the cell to the last area if it is near that area's first cell, else open a new one."""
    last = F.element_at(areas, -1)
    d_lat, d_lon = cell["lat"] - last["lat"], cell["lon"] - last["lon"]
    near = (d_lat * d_lat + d_lon * d_lon).cast("double") < F.lit(reach * reach)
    grown = F.struct(
        last["lat"].alias("lat"), last["lon"].alias("lon"),
        (last["count"] + cell["count"]).alias("count"),
    )
    before = F.slice(areas, F.lit(1), F.size(areas) - F.lit(1))
    return (
        F.when(F.size(areas) == 0, F.array(cell))
        .when(near, F.concat(before, F.array(grown)))
        .when(F.size(areas) < n, F.concat(areas, F.array(cell)))
        .otherwise(areas)
    )


def dense_areas(
    points: DataFrame, n: int = AREAS, tol: float = MERGE_TOL, prec: int = CELL_PREC,
    rate: float = 1.0, key: str = "event_id", seed: str = "areas", candidates: int | None = None,
) -> DataFrame:
    """The densest areas with their counts, which are lower bounds: cells that are not walked are not counted.

    The ``candidates`` (2n, if not given) largest cells are walked in (lat, lon) order; a cell nearer than ``tol`` to the first
    cell of the current area joins it, any other opens an area while there are fewer than ``n``.
    With ``rate`` below 1 a reproducible sample is counted and scaled back. Counting and the top
    cells are distributed; the walk sees at most ``candidates`` rows, in one task. Distances are exact, in grid steps.
    """
    sampled = hash_sample(points, key, rate, seed)
    top = top_cells(_cells(sampled, prec), 2 * n if candidates is None else candidates)
    reach = round(tol * 10**prec, 6)
    walk = top.agg(F.array_sort(F.collect_list(F.struct("lat", "lon", "count"))).alias("cells"))
    areas = F.aggregate(
        "cells", F.array().cast(f"array<{_AREA}>"), lambda acc, cell: _merge(acc, cell, n, reach)
    )
    step = F.lit(float(10**prec))
    return walk.select(F.inline(areas)).select(
        (F.col("lat") / step).alias("lat"),
        (F.col("lon") / step).alias("lon"),
        F.round(F.col("count") / F.lit(rate)).cast("bigint").alias("count"),
    )


# A cell's place in (lat, lon) order as one number.
_ROW = 1 << 32


def _place(lat: Column, lon: Column) -> Column:
    return lat * F.lit(_ROW) + lon + F.lit(_ROW >> 1)


def _rows_after(count: int) -> Column:
    return F.explode(F.sequence(F.col("lat") + F.lit(1), F.col("lat") + F.lit(count)))


def _after_empty_rows(rows: DataFrame, far: int) -> DataFrame:
    """Rows of the grid without another in the ``far - 1`` rows before."""
    return rows.join(rows.select(_rows_after(far - 1).alias("lat")).distinct(), "lat", "left_anti") if far > 1 else rows


def _next_opening(cells: DataFrame, reach: float) -> DataFrame:
    """(id, next): of every cell, if it is the first of an area, the first later cell that is not near it; null if that
    is the first cell of a segment, or if there is none.

    In the cell's own row it is the one after the last near cell, found in a frame of ``reach`` steps. Only the last cells of a row
    go on to the rows after it, and need no more of those than the cells within twice the reach of the row's first.
    """
    far = math.ceil(reach)  # from so many rows or steps on, cells are not near
    row = Window.partitionBy("lat").orderBy("lon")
    ahead = F.max(F.struct("lon", "after")).over(row.rangeBetween(0, far - 1))["after"]
    own = cells.withColumn("after", F.lead("lon").over(row)).withColumn("after", ahead)

    rows = cells.groupBy("lat").agg(F.min("lon").alias("head"))
    opens = _after_empty_rows(rows, far).select("lat", F.lit(True).alias("opens"))
    rows = rows.join(opens, "lat", "left")

    near_head = F.col("lon") - F.col("head") <= 2 * far
    heads = cells.join(rows, "lat").groupBy("lat", "head", "opens").agg(
        F.array_sort(F.collect_list(F.when(near_head, F.col("lon")))).alias("lons"), F.min(F.when(~near_head, F.col("lon"))).alias("beyond")
    )
    d_lat = F.col("lat") - F.col("from_lat")
    away = lambda lon: (d_lat * d_lat + (lon - F.col("from_lon")) * (lon - F.col("from_lon"))).cast("double") >= F.lit(reach * reach)
    tails = own.where("after IS NULL").select(
        F.col("lat").alias("from_lat"), F.col("lon").alias("from_lon"), _rows_after(2 * far - 1).alias("lat")
    )
    found = F.coalesce(F.get(F.filter("lons", away), F.lit(0)), F.col("beyond"))
    down = (
        tails.join(heads, "lat").withColumn("lon", found).where("lon IS NOT NULL")
        .groupBy("from_lat", "from_lon")
        .agg(F.min(F.struct("lat", "lon", F.coalesce("opens", F.lit(False)).alias("opens"))).alias("down"))
        .select(_place(F.col("from_lat"), F.col("from_lon")).alias("id"), "down")
    )
    below = F.when(~F.col("down.opens"), _place(F.col("down.lat"), F.col("down.lon")))
    here = own.select(_place(F.col("lat"), F.col("lon")).alias("id"), F.when(F.col("after").isNotNull(), _place(F.col("lat"), F.col("after"))).alias("here"))
    return here.join(down, "id", "left").select("id", F.coalesce("here", below).alias("next"))


def _segment_heads(cells: DataFrame, reach: float) -> DataFrame:
    """Cells that open an area wherever the walk comes from: those after ``reach`` empty rows, and the first of all."""
    rows = _after_empty_rows(cells.groupBy("lat").agg(F.min("lon").alias("lon")), math.ceil(reach))
    return rows.select(_place(F.col("lat"), F.col("lon")).alias("id"))


def _anchors(cells: DataFrame, reach: float) -> DataFrame:
    """(id, next) of the cells that open areas: what the links reach from the heads of the segments.

    Links are doubled: after k rounds they jump 2**k areas, and the cells found are those up to 2**k areas behind a
    head. A walk of n areas takes log2(n) rounds of joins on unique cells.
    """
    links = written(_next_opening(cells, reach), "links")
    jumps, found = links.where("next IS NOT NULL"), written(_segment_heads(cells, reach), "found")
    while True:
        more = found.join(jumps, "id").select(F.col("next").alias("id"))
        more = written(more.join(found, "id", "left_anti").distinct(), "found")
        if more.isEmpty():
            return found.join(links, "id")
        found = written(found.unionAll(more), "found")
        second = jumps.select(F.col("id").alias("next"), F.col("next").alias("then"))
        jumps = written(jumps.join(second, "next").select("id", F.col("then").alias("next")), "jumps")


def all_areas(points: DataFrame, tol: float = MERGE_TOL, prec: int = CELL_PREC) -> DataFrame:
    """Every area of the walk over all cells in (lat, lon) order: first cell and whole ``count``.

    A cell nearer than ``tol`` to the first cell of the area before it joins that area, any other opens one. No task sees
    all cells: which cell would end the area of another is worked out for all cells at once, and the cells
    that do open areas are found by following these links. An area lies within ``tol`` of its first cell, so cells
    meet the first cells of their own square of the grid and of those beside it only.
    """
    reach = round(tol * 10**prec, 6)
    if not reach > 0:
        raise ValueError("areas need a merge distance above zero")
    cells = written(_cells(points.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()), prec), "cells")
    size = math.ceil(reach)
    lat = F.floor(F.col("id") / F.lit(_ROW)).cast("bigint")
    anchors = _anchors(cells, reach).select(
        lat.alias("a_lat"), (F.col("id") - lat * F.lit(_ROW) - F.lit(_ROW >> 1)).alias("a_lon"), F.col("id").alias("first"), "next"
    )
    square = lambda v: F.floor(v / F.lit(size)).cast("bigint")
    both = F.sequence(square(F.col("a_lat")), square(F.col("a_lat") + size))
    sides = F.sequence(square(F.col("a_lon") - size), square(F.col("a_lon") + size))
    anchors = anchors.withColumn("x", F.explode(both)).withColumn("y", F.explode(sides))
    placed = cells.select("*", _place(F.col("lat"), F.col("lon")).alias("id"), square(F.col("lat")).alias("x"), square(F.col("lon")).alias("y"))
    d_lat, d_lon = F.col("lat") - F.col("a_lat"), F.col("lon") - F.col("a_lon")
    near = (d_lat * d_lat + d_lon * d_lon).cast("double") < F.lit(reach * reach)
    own = (F.col("id") >= F.col("first")) & (F.col("next").isNull() | (F.col("id") < F.col("next"))) & near
    step = F.lit(float(10**prec))
    areas = placed.join(anchors, ["x", "y"]).where(own).groupBy("a_lat", "a_lon").agg(F.sum("count").alias("count"))
    return areas.select((F.col("a_lat") / step).alias("lat"), (F.col("a_lon") / step).alias("lon"), "count")


def dense_areas_exact(points: DataFrame, n: int = AREAS, tol: float = MERGE_TOL, prec: int = CELL_PREC) -> DataFrame:
    """The ``n`` areas with the highest counts, which are whole; equal counts by lat, then lon."""
    return all_areas(points, tol, prec).orderBy(F.desc("count"), "lat", "lon").limit(n)
