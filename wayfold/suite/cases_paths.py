"""Cells, areas, samples, paths."""

from pyspark.sql import functions as F

from wayfold.operators import density, geo, sampling
from wayfold.plans import charts
from wayfold.suite.registry import case
from wayfold.suite.views import END, START, snap, sql, table

CELL = "floor({} * 10000::DOUBLE + 0.5::DOUBLE)"
CELLS_SQL = f"""
    SELECT CAST({CELL.format('lat')} AS BIGINT) AS a, CAST({CELL.format('lon')} AS BIGINT) AS b, count(*) AS n
    FROM rows GROUP BY ALL"""
TOP_SQL = "SELECT *, row_number() OVER (ORDER BY a, b) AS i FROM (SELECT * FROM cells ORDER BY n DESC, a, b LIMIT 40)"


def walk_sql(tol: int = 20) -> str:
    """Areas by walking the numbered cells; ``tol`` in grid steps."""
    near = f"((t.a - w.a) * (t.a - w.a) + (t.b - w.b) * (t.b - w.b)) < {tol * tol}"
    return f"""
        SELECT i, 1 AS area, a, b, n, true AS counted FROM top WHERE i = 1
        UNION ALL
        SELECT t.i, CASE WHEN {near} OR w.area >= 20 THEN w.area ELSE w.area + 1 END,
               CASE WHEN {near} OR w.area >= 20 THEN w.a ELSE t.a END,
               CASE WHEN {near} OR w.area >= 20 THEN w.b ELSE t.b END, t.n, {near} OR w.area < 20
        FROM walk w JOIN top t ON t.i = w.i + 1"""


def areas_sql(scale: int = 1) -> str:
    return f"""
        SELECT any_value(a) / 10000::DOUBLE AS lat, any_value(b) / 10000::DOUBLE AS lon,
               CAST(sum(n) FILTER (counted) * {scale} AS BIGINT) AS count
        FROM walk GROUP BY area"""


def _areas(rows: str, scale: int = 1, tol: int = 20) -> str:
    text = sql(
        areas_sql(scale), "snap", rows=rows, cells=CELLS_SQL, top=TOP_SQL, walk=walk_sql(tol)
    )
    return text.replace("WITH snap", "WITH RECURSIVE snap", 1)


@case("grid_cell", sql(f"SELECT event_id, {CELL.format('lat')} / 10000::DOUBLE AS lat, "
                       f"{CELL.format('lon')} / 10000::DOUBLE AS lon FROM snap", "snap"))
def _(spark, sf):
    return snap(spark, sf).select(
        "event_id", geo.grid_cell(F.col("lat")).alias("lat"), geo.grid_cell(F.col("lon")).alias("lon")
    )


@case(
    "cell_counts",
    sql("SELECT a / 10000::DOUBLE AS lat, b / 10000::DOUBLE AS lon, n AS count FROM cells",
        "snap", rows="SELECT * FROM snap", cells=CELLS_SQL),
)
def _(spark, sf):
    return density.cell_counts(snap(spark, sf))


@case(
    "top_cells",
    sql("SELECT a / 10000::DOUBLE AS lat, b / 10000::DOUBLE AS lon, n AS count FROM top",
        "snap", rows="SELECT * FROM snap", cells=CELLS_SQL, top=TOP_SQL),
)
def _(spark, sf):
    return density.top_cells(density.cell_counts(snap(spark, sf)))


@case("dense_areas", _areas("SELECT * FROM snap"))
def dense_areas(spark, sf):
    return density.dense_areas(snap(spark, sf))


@case("dense_areas_narrow", _areas("SELECT * FROM snap", tol=12))
def _(spark, sf):
    return density.dense_areas(snap(spark, sf), tol=0.0012)


def _exact_areas(rows: str, tol: int, limit: str) -> str:
    """The walk over all cells, one after the other."""
    near = f"((t.a - w.a) * (t.a - w.a) + (t.b - w.b) * (t.b - w.b)) < {tol * tol}"
    walk = f"""
        SELECT i, a, b, n FROM top WHERE i = 1
        UNION ALL
        SELECT t.i, CASE WHEN {near} THEN w.a ELSE t.a END, CASE WHEN {near} THEN w.b ELSE t.b END, t.n
        FROM walk w JOIN top t ON t.i = w.i + 1"""
    select = f"""
        SELECT a / 10000::DOUBLE AS lat, b / 10000::DOUBLE AS lon, CAST(sum(n) AS BIGINT) AS count
        FROM walk GROUP BY a, b ORDER BY count DESC, lat, lon {limit}"""
    text = sql(select, "snap", rows=rows, cells=CELLS_SQL, top="SELECT *, row_number() OVER (ORDER BY a, b) AS i FROM cells", walk=walk)
    return text.replace("WITH snap", "WITH RECURSIVE snap", 1)


#: The snapshots, each moved a little by its number: many cells, some of them in rows far apart.
SCATTER = (("lat", "(event_id * 7919) % 3001"), ("lon", "(event_id * 104729) % 4001"))


def _scattered(spark, sf):
    moved = {c: F.col(c) + F.expr(f"cast({e} AS double) / 1e5D + if(event_id % 3 = 0, 0.5D, 0D)") for c, e in SCATTER}
    return snap(spark, sf).withColumns(moved)


_SCATTERED_SQL = "SELECT " + ", ".join(
    f"{c} + (CAST({e} AS DOUBLE) / 1e5::DOUBLE + CASE WHEN event_id % 3 = 0 THEN 0.5::DOUBLE ELSE 0::DOUBLE END) AS {c}" for c, e in SCATTER
) + " FROM snap"


@case("dense_areas_exact", _exact_areas("SELECT * FROM snap", 20, "LIMIT 20"))
def _(spark, sf):
    return density.dense_areas_exact(snap(spark, sf))


@case("all_areas", _exact_areas(_SCATTERED_SQL, 20, ""))
def _(spark, sf):
    return density.all_areas(_scattered(spark, sf))


SAMPLE = "substr(md5('{}' || event_id), 1, 8) < '80000000'"


@case("dense_areas_sampled", _areas(f"SELECT * FROM snap WHERE {SAMPLE.format('areas')}", scale=2))
def _(spark, sf):
    return density.dense_areas(snap(spark, sf), rate=0.5)


@case(
    "chart_density",
    sql(
        """SELECT '{"lat":' || lat || ',"lon":' || lon || ',"count":' || count || '}' AS json FROM areas""",
        areas=_areas(f"SELECT * FROM snap WHERE dateTime >= TIMESTAMP '{START}' AND dateTime < TIMESTAMP '{END}'"),
    ),
)
def _(spark, sf):
    return charts.density(snap(spark, sf), START, END)


@case("hash_sample", sql(f"SELECT event_id FROM snap WHERE {SAMPLE.format('sample')}", "snap"))
def _(spark, sf):
    return sampling.hash_sample(snap(spark, sf), "event_id", 0.5).select("event_id")


@case(
    "coord_stats",
    sql(
        """SELECT station_id, round(avg(lat), 6) AS lat_mean, round(stddev_pop(lat), 6) AS lat_sd,
                  round(avg(lon), 6) AS lon_mean, round(stddev_pop(lon), 6) AS lon_sd
           FROM snap GROUP BY station_id""",
        "snap",
    ),
)
def _(spark, sf):
    stats = geo.coord_stats(snap(spark, sf), by=["station_id"])
    return stats.select("station_id", *[F.round(c, 6).alias(c) for c in stats.columns[1:]])


BOUNDS_SQL = """
    SELECT {}round(avg({x}) - 2::DOUBLE * stddev_pop({x}), 6) AS x_lo, round(avg({x}) + 2::DOUBLE * stddev_pop({x}), 6) AS x_hi,
           round(avg({y}) - 2::DOUBLE * stddev_pop({y}), 6) AS y_lo, round(avg({y}) + 2::DOUBLE * stddev_pop({y}), 6) AS y_hi
    FROM {rows}"""


@case(
    "within_sigma",
    """SELECT o_orderkey, o_totalprice, l_quantity FROM (SELECT * FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
       WHERE o_totalprice BETWEEN (SELECT round(avg(o_totalprice) - 1.5::DOUBLE * stddev_pop(o_totalprice), 6)
                                   FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
                              AND (SELECT round(avg(o_totalprice) + 1.5::DOUBLE * stddev_pop(o_totalprice), 6)
                                   FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
         AND l_quantity BETWEEN (SELECT round(avg(l_quantity) - 1.5::DOUBLE * stddev_pop(l_quantity), 6)
                                   FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
                              AND (SELECT round(avg(l_quantity) + 1.5::DOUBLE * stddev_pop(l_quantity), 6)
                                   FROM orders JOIN lineitem ON l_orderkey = o_orderkey)""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    joined = table(spark, sf, "orders").select("o_orderkey", "o_totalprice").join(lines, "o_orderkey")
    return geo.within_sigma(joined, ["o_totalprice", "l_quantity"], k=1.5)


@case(
    "within_sigma_by_type",
    """SELECT event_id FROM events JOIN (
           SELECT event_type, round(avg(value) - 2::DOUBLE * stddev_pop(value), 6) AS lo,
                  round(avg(value) + 2::DOUBLE * stddev_pop(value), 6) AS hi
           FROM events GROUP BY event_type) USING (event_type)
       WHERE value BETWEEN lo AND hi""",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    return geo.within_sigma(events, ["value"], by=["event_type"]).select("event_id")


def path_sql(rows: str, by: str = "station_id") -> str:
    return sql(
        f"""SELECT station_id, dateTime, lat, lon, event_id, stratum FROM (
               SELECT *, CASE WHEN hi > lo THEN least(CAST(floor((x - lo) / ((hi - lo) / 10::DOUBLE)) AS INT), 9)
                         ELSE 0 END AS stratum
               FROM (SELECT r.*, CASE WHEN wide THEN lat ELSE lon END AS x, CASE WHEN wide THEN x_lo ELSE y_lo END AS lo,
                            CASE WHEN wide THEN x_hi ELSE y_hi END AS hi
                     FROM rows r JOIN (SELECT *, (x_hi - x_lo) > (y_hi - y_lo) AS wide FROM bounds) USING (station_id)
                     WHERE lat BETWEEN x_lo AND x_hi AND lon BETWEEN y_lo AND y_hi))
            QUALIFY row_number() OVER (PARTITION BY station_id, stratum ORDER BY md5('path' || event_id), event_id) <= 40""",
        "snap", rows=rows,
        bounds=BOUNDS_SQL.format("station_id, ", x="lat", y="lon", rows="rows") + " GROUP BY station_id",
    )


HALF = f"SELECT * FROM snap WHERE {SAMPLE.format('path')}"


@case("path_sample", path_sql(HALF))
def path_sample(spark, sf):
    return sampling.path_sample(snap(spark, sf), START, END, rate=0.5)


@case("path_sample_full", path_sql("SELECT * FROM snap"))
def _(spark, sf):
    """Every station at the full rate."""
    return sampling.path_sample(snap(spark, sf), START, END)


@case("path_sample_station", path_sql("SELECT * FROM snap WHERE station_id = 3"))
def _(spark, sf):
    """One route: its bounds come from a scalar subquery instead of a join."""
    return sampling.path_sample(snap(spark, sf), START, END, station=3)


@case(
    "chart_path",
    sql(
        """SELECT '{"lat":' || lat || ',"lon":' || lon || ',"dateTime":"'
               || strftime(dateTime, '%Y-%m-%d %H:%M:%S') || '"}' AS json FROM path""",
        path=path_sql("SELECT * FROM snap WHERE station_id = 3"),
    ),
)
def _(spark, sf):
    """The chart shows one route."""
    return charts.path(snap(spark, sf), 3, START, END)
