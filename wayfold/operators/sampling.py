"""Reproducible samples and the sampled path of a route."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from wayfold.operators.geo import sigma_bounds, with_bounds
from wayfold.plans.ranking import top_per_group
from wayfold.sources.readers import scan_range

# Fixed values of the path sample.
STRATA = 10
PATH_ROWS = 400
SIGMAS = 2.0


def hash_order(key: str, seed: str) -> Column:
    """A reproducible random sort key for each row."""
    return F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))


def hash_sample(df: DataFrame, key: str, rate: float, seed: str = "sample") -> DataFrame:
    """Keep each row with probability ``rate``; the same rows whenever and wherever it runs."""
    if rate >= 1:
        return df
    limit = format(int(rate * 2**32), "08x")
    return df.where(F.substring(hash_order(key, seed), 1, 8) < F.lit(limit))


def random_sample(df: DataFrame, rate: float, seed: int | None = None) -> DataFrame:
    """Plain Bernoulli sample; differs with the partitioning of the input."""
    return df.sample(withReplacement=False, fraction=rate, seed=seed)


def path_sample(
    snap: DataFrame, start: str | datetime, end: str | datetime, station: int | None = None,
    strata: int = STRATA, cap: int = PATH_ROWS, k: float = SIGMAS, rate: float = 1.0,
    key: str = "event_id", seed: str = "path",
) -> DataFrame:
    """Up to ``cap`` records along each route, spread evenly over its main axis.

    Per station, the axis with the wider mean -/+ k sigma range is cut into equal strata, the last
    closed on the right. Rows outside the range of either axis are left out; each stratum gives
    at most ``cap / strata`` rows in reproducible random order, the first ones one more if that
    leaves a remainder.
    """
    if not 0 < strata <= cap:
        raise ValueError("cap must be the number of strata at least")
    chosen = () if station is None else ("station_id", station)
    rows = scan_range(snap, "dateTime", start, end, *chosen)
    rows = hash_sample(rows.select("station_id", "dateTime", "lat", "lon", key), key, rate, seed)
    by: Sequence[str] = ("station_id",) if station is None else ()

    placed = with_bounds(rows, sigma_bounds(rows, k=k, by=by), by)
    lat_wider = (F.col("lat_hi") - F.col("lat_lo")) > (F.col("lon_hi") - F.col("lon_lo"))

    def main(lat: str, lon: str) -> Column:
        return F.when(lat_wider, F.col(lat)).otherwise(F.col(lon))

    width = (main("lat_hi", "lon_hi") - main("lat_lo", "lon_lo")) / F.lit(strata)
    step = F.floor(F.try_divide(main("lat", "lon") - main("lat_lo", "lon_lo"), width))
    inside = F.col("lat").between(F.col("lat_lo"), F.col("lat_hi")) & F.col("lon").between(
        F.col("lon_lo"), F.col("lon_hi")
    )
    stratum = F.least(F.coalesce(step, F.lit(0)), F.lit(strata - 1)).cast("int")
    spread_out = placed.where(inside).select(
        "station_id", "dateTime", "lat", "lon", key,
        stratum.alias("stratum"), hash_order(key, seed).alias("__order"),
    )
    order = [F.col("__order"), F.col(key)]
    group, (each, more) = ["station_id", "stratum"], divmod(cap, strata)
    if not more:
        return top_per_group(spread_out, group, order, each).drop("__order")
    first = top_per_group(spread_out.where(F.col("stratum") < more), group, order, each + 1)
    rest = top_per_group(spread_out.where(F.col("stratum") >= more), group, order, each)
    return first.unionByName(rest).drop("__order")
