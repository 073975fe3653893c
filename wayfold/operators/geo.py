"""Boxes, grid cells and coordinate statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wayfold.plans.joins import join_dim, join_stats

# Decimals an anchor is rounded to, and half the width of its box in degrees.
PREC = 3
TOL = 0.002


def in_box(
    lat: Column, lon: Column, anchor_lat: Column, anchor_lon: Column,
    prec: int = PREC, tol: float = TOL,
) -> Column:
    """Whether a point lies in the closed box round a rounded anchor."""
    def near(value: Column, anchor: Column) -> Column:
        centre = F.round(anchor, prec)
        return value.between(centre - F.lit(tol), centre + F.lit(tol))

    return near(lat, anchor_lat) & near(lon, anchor_lon)


def loop_factor(prec: int = PREC, tol: float = TOL) -> Column:
    """2 for a route that ends in its own start box, else 1."""
    loops = in_box(F.col("end_lat"), F.col("end_lon"), F.col("start_lat"), F.col("start_lon"), prec, tol)
    return F.when(loops, 2).otherwise(1)


def scaled(count: Column, factor: Column) -> Column:
    """A count divided by the loop factor, rounded down."""
    return ((count - count % factor) / factor).cast("bigint")


def grid_units(value: Column, prec: int = 4) -> Column:
    """A coordinate as a whole number of grid steps; a half step rounds up."""
    return F.floor(value * F.lit(float(10**prec)) + F.lit(0.5))


def grid_cell(value: Column, prec: int = 4) -> Column:
    return grid_units(value, prec) / F.lit(float(10**prec))


def _spread(bits: Column) -> Column:
    """The low 16 bits, each followed by an empty one."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask))
    return bits


def morton(lat: Column, lon: Column) -> Column:
    """Place of a point on a curve that fills the globe in 2**16 rows and columns: points near each other are mostly
    near on it, so files sorted by it hold small rectangles. Points off the globe count as on its edge."""
    def cell(value: Column, span: float) -> Column:
        scaled_ = F.floor((value + F.lit(span)) / F.lit(2 * span) * F.lit(65536.0))
        return F.when(value.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(65535), scaled_))).cast("bigint")

    return F.shiftleft(_spread(cell(lat, 90.0)), 1).bitwiseOR(_spread(cell(lon, 180.0)))


def box_envelope(routes: DataFrame, end: str = "start", prec: int = PREC, tol: float = TOL) -> tuple[float, float, float, float] | None:
    """(least and greatest latitude, least and greatest longitude) of all boxes; None without routes. One row is collected."""
    edges = [f(F.round(f"{end}_{axis}", prec) + F.lit(side * tol)) for axis in ("lat", "lon") for f, side in ((F.min, -1), (F.max, 1))]
    found = routes.agg(*edges).first()
    return None if found[0] is None else tuple(found)


def in_envelope(snap: DataFrame, envelope: tuple[float, float, float, float] | None) -> DataFrame:
    """Snapshots inside the envelope: plain bounds, which reach the file, so that row groups outside are skipped."""
    if envelope is None:
        return snap.where(F.lit(False))
    lat_lo, lat_hi, lon_lo, lon_hi = envelope
    return snap.where(F.col("lat").between(lat_lo, lat_hi) & F.col("lon").between(lon_lo, lon_hi))


def snap_in_box(
    snap: DataFrame, routes: DataFrame, end: str = "start", prec: int = PREC, tol: float = TOL
) -> DataFrame:
    """Snapshots inside the start (or end) box of their own route, plus the loop ``factor``.

    The box is worked out once per route; the join is an equality on the station with the box as
    residual condition.
    """
    lat, lon = F.round(f"{end}_lat", prec), F.round(f"{end}_lon", prec)
    boxes = routes.select(
        "station_id",
        loop_factor(prec, tol).alias("factor"),
        (lat - F.lit(tol)).alias("__lat_lo"),
        (lat + F.lit(tol)).alias("__lat_hi"),
        (lon - F.lit(tol)).alias("__lon_lo"),
        (lon + F.lit(tol)).alias("__lon_hi"),
    )
    return (
        join_dim(snap, boxes, "station_id")
        .where(
            F.col("lat").between(F.col("__lat_lo"), F.col("__lat_hi"))
            & F.col("lon").between(F.col("__lon_lo"), F.col("__lon_hi"))
        )
        .drop("__lat_lo", "__lat_hi", "__lon_lo", "__lon_hi")
    )


def coord_stats(df: DataFrame, cols: Sequence[str] = ("lat", "lon"), by: Sequence[str] = ()) -> DataFrame:
    """Mean and population standard deviation of each coordinate."""
    measures = [
        measure(c).alias(f"{c}_{name}")
        for c in cols
        for name, measure in (("mean", F.avg), ("sd", F.stddev_pop))
    ]
    return df.groupBy(*by).agg(*measures)


def sigma_bounds(
    df: DataFrame, cols: Sequence[str] = ("lat", "lon"), k: float = 2.0, by: Sequence[str] = (),
    digits: int | None = 6,
) -> DataFrame:
    """Mean -/+ k standard deviations per coordinate, rounded to ``digits`` decimals, if any."""
    def edge(c: str, sign: int) -> Column:
        exact = F.col(f"{c}_mean") + F.lit(sign * k) * F.col(f"{c}_sd")
        return exact if digits is None else F.round(exact, digits)

    edges = [edge(c, sign).alias(f"{c}_{name}") for c in cols for name, sign in (("lo", -1), ("hi", 1))]
    return coord_stats(df, cols, by).select(*by, *edges)


def with_bounds(df: DataFrame, bounds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Put the bounds of its group (or the only bounds there are) beside each row.

    The one-row case is a scalar subquery: no join and no shuffle of ``df``.
    """
    if by:
        return join_stats(df, bounds, by)
    only = "__bounds"
    names = bounds.columns
    whole = df.withColumn(only, bounds.select(F.struct(*names)).scalar())
    return whole.withColumns({n: F.col(only)[n] for n in names}).drop(only)


def within_sigma(
    df: DataFrame, cols: Sequence[str] = ("lat", "lon"), k: float = 2.0, by: Sequence[str] = ()
) -> DataFrame:
    """Rows whose coordinates all lie within mean -/+ k standard deviations."""
    inside = with_bounds(df, sigma_bounds(df, cols, k, by, digits=None), by)
    for c in cols:
        inside = inside.where(F.col(c).between(F.col(f"{c}_lo"), F.col(f"{c}_hi")))
    return inside.select(*df.columns)
