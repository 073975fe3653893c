"""Sources and sinks."""

import json
import random

import pytest
from pyspark.sql import functions as F, types as T

from helpers import at, routes, rows, snapshots
from wayfold import schemas
from wayfold.sources import readers, types, writers


def test_jdbc_options():
    options = readers.jdbc_options(
        "jdbc:x://host/db", "SELECT a FROM t WHERE a > 1;", ("a", 0, 100, 8), fetchsize=1000
    )
    assert options == {
        "url": "jdbc:x://host/db", "dbtable": "(SELECT a FROM t WHERE a > 1) AS T", "partitionColumn": "a",
        "lowerBound": "0", "upperBound": "100", "numPartitions": "8", "fetchsize": "1000",
    }
    assert "numPartitions" not in readers.jdbc_options("jdbc:x://host/db", "SELECT 1")


def test_json_records_fail_on_a_broken_line(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1, "b": "x"}\n{"a": 2}\n')
    schema = T.StructType.fromDDL("a int, b string")
    assert rows(readers.read_json_records(spark, str(tmp_path), schema)) == [(1, "x"), (2, None)]
    (tmp_path / "b.json").write_text("{broken\n")
    with pytest.raises(Exception):
        readers.read_json_records(spark, str(tmp_path), schema).collect()


def test_delimited(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("1\tx y\t2.5\n2\t\\N\t\\N\n")
    schema = T.StructType.fromDDL("a int, b string, c double")
    assert rows(readers.load_delimited(spark, str(tmp_path), schema)) == [(1, "x y", 2.5), (2, None, None)]
    (tmp_path / "b.csv").write_text('3,"x, y",1.0\n')
    quoted = readers.load_delimited(spark, str(tmp_path / "b.csv"), schema, sep=",", quote='"')
    assert rows(quoted) == [(3, "x, y", 1.0)]


def test_routes(spark, tmp_path):
    path = str(tmp_path / "routes")
    routes(spark).write.parquet(path)
    loaded = readers.load_routes(spark, path)
    assert loaded.schema == schemas.ROUTES
    assert rows(readers.route_start(loaded, 1)) == [(43.6, -79.4)]


def test_appending_a_day_again_replaces_only_that_day(spark, tmp_path):
    path = str(tmp_path / "fact")

    def fact(*rows_):
        return spark.createDataFrame(list(rows_), schemas.FREQUENCY_FACT)

    writers.append_fact(fact((1, at("00:00"), 3), (1, at("1 00:00"), 4)), path)
    writers.append_fact(fact((1, at("1 00:00"), 5), (2, at("1 00:00"), 6)), path)
    found = spark.read.parquet(path).select("station_id", "startTime", "freq")
    assert rows(found) == [(1, at("00:00"), 3), (1, at("1 00:00"), 5), (2, at("1 00:00"), 6)]


def test_chart_json_keeps_the_order_of_rows_and_fields(spark, tmp_path):
    frame = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "n int, name string")
    lines = [r.json for r in writers.chart_json(frame, ["name", "n"], F.desc("n")).collect()]
    assert lines == ['{"name":"c","n":3}', '{"name":"b","n":2}', '{"name":"a","n":1}']
    writers.write_chart_json(frame, ["name", "n"], "n", str(tmp_path / "chart"))
    written = spark.read.text(str(tmp_path / "chart")).collect()
    assert sorted(json.loads(r.value)["n"] for r in written) == [1, 2, 3]


def test_empty(spark):
    frame = readers.empty(spark, schemas.TRAVEL_FACT)
    assert frame.schema == schemas.TRAVEL_FACT and frame.isEmpty()


def test_shared_dir_is_where_the_session_says(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = writers.shared_dir(spark, "x")
    assert path != writers.shared_dir(spark, "x")
    assert root is None or path.startswith(root)


def test_source_types(spark):
    schema = types.source_schema(
        [("a", "decimal", 12, 3), ("b", "TINYINT", 1), ("c", "TINYINT", 4), ("d", "BIT"), ("e", "BIT", 8),
         ("f", "YEAR"), ("g", "DATETIME"), ("h", "time"), ("i", "SET")]
    )
    assert [f.dataType.simpleString() for f in schema] == [
        "decimal(12,3)", "boolean", "tinyint", "boolean", "binary", "date", "timestamp_ntz", "bigint", "string"
    ]
    plain = types.source_schema([("b", "TINYINT", 1), ("f", "YEAR")], tiny_as_bool=False, year_as_date=False)
    assert [f.dataType.simpleString() for f in plain] == ["tinyint", "smallint"]
    with pytest.raises(ValueError):
        types.source_type("VECTOR")
    sets = spark.createDataFrame([("a,b",), ("",), (None,)], "s string").select(types.set_to_array(F.col("s")))
    assert [r[0] for r in sets.collect()] == [["a", "b"], [], None]


def test_the_envelope_skips_row_groups(spark, tmp_path):
    """The same rows, fewer of the file's row groups; bounds are pushed to the scan."""
    import pyarrow.parquet as pq

    from wayfold.operators import geo
    from wayfold.sources import ledger

    rng = random.Random(3)
    moved = [(f"{m // 1440} {m // 60 % 24:02d}:{m % 60:02d}", {"lat": 43 + rng.random(), "lon": -80 + rng.random()}) for m in range(0, 2880, 1)]
    near = [(f"{m // 1440} {m // 60 % 24:02d}:{m % 60:02d}", {}) for m in range(0, 2880, 48)]
    snap = snapshots(spark, moved + near)
    stops = routes(spark)
    groups = {}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.maxMetadataStringLength", "3000")
    try:
        for name, order in (("plain", None), ("near", geo.morton(F.col("lat"), F.col("lon")))):
            path = str(tmp_path / name)
            spark._jsc.hadoopConfiguration().set("parquet.block.size", "4096")
            spark._jsc.hadoopConfiguration().set("parquet.block.size.row.check.min", "50")
            ledger.publish_days(snap, path, "2024-01-01", "2024-01-03", "dateTime", near=order)
            envelope = geo.box_envelope(stops)
            rows = geo.in_envelope(ledger.read_published(spark, path, "2024-01-01", "2024-01-03", "dateTime"), envelope)
            assert geo.snap_in_box(rows, stops).count() == geo.snap_in_box(snap, stops).count() >= 60
            pushed = rows._jdf.queryExecution().executedPlan().toString()
            assert "GreaterThanOrEqual(lat," in pushed and "LessThanOrEqual(lon," in pushed
            read = whole = 0
            for file in rows.inputFiles():
                meta = pq.ParquetFile(file.removeprefix("file://")).metadata
                for g in range(meta.num_row_groups):
                    stats = {c.path_in_schema: c.statistics for c in (meta.row_group(g).column(k) for k in range(meta.num_columns))}
                    whole += 1
                    read += stats["lat"].max >= envelope[0] and stats["lat"].min <= envelope[1] and stats["lon"].max >= envelope[2] and stats["lon"].min <= envelope[3]
            groups[name] = read, whole
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        for key in ("parquet.block.size", "parquet.block.size.row.check.min"):
            spark._jsc.hadoopConfiguration().unset(key)
    assert groups["near"][0] < 0.5 * groups["near"][1] and groups["near"][1] >= 4
    assert groups["near"][0] / groups["near"][1] < 0.7 * groups["plain"][0] / groups["plain"][1], groups
    assert geo.box_envelope(stops.where("false")) is None and geo.in_envelope(snap, None).count() == 0


def test_morton_interleaves(spark):
    from wayfold.operators import geo

    points = [(-90.0, -180.0), (90.0, 180.0), (0.0, 0.0), (-95.0, 200.0), (43.6, -79.4), (None, 1.0)]
    frame = spark.createDataFrame(points, "lat double, lon double")

    def by_hand(lat, lon):
        if lat is None:
            return None
        cell = lambda v, span: max(0, min(65535, int((v + span) / (2 * span) * 65536 // 1)))
        a, b = cell(lat, 90), cell(lon, 180)
        return sum(((a >> k & 1) << (2 * k + 1)) | ((b >> k & 1) << (2 * k)) for k in range(16))

    got = frame.select("lat", "lon", geo.morton(F.col("lat"), F.col("lon")).alias("m")).collect()
    assert [r.m for r in got] == [by_hand(r.lat, r.lon) for r in got]
