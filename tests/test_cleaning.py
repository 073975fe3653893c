"""Value cleaning, guards, conversions, named functions."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import rows
from wayfold.functions import named, time
from wayfold.operators import endpoints, quality
from wayfold.plans.timing import micros_between, window_of
from wayfold.plans import charts


def one(spark, value, column, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize("zero", ["0", " 0 ", "0000-00-00", "0000-00-00 00:00:00", "00000000000000"])
def test_zero_dates(spark, zero):
    assert one(spark, zero, lambda c: quality.zero_date(c, "null")) is None
    assert one(spark, zero, lambda c: quality.zero_date(c, "round")) == date(1, 1, 1)
    with pytest.raises(Exception, match="zero date"):
        one(spark, zero, quality.zero_date)


def test_real_dates_pass(spark):
    assert one(spark, "2024-02-29", quality.zero_date) == date(2024, 2, 29)
    stamp = one(spark, "2024-02-29 10:11:12", lambda c: quality.zero_date(c, to="timestamp_ntz"))
    assert stamp == datetime(2024, 2, 29, 10, 11, 12)


@pytest.mark.parametrize("short, full", [(69, 2069), (70, 1970), (0, 2000), (99, 1999)])
def test_two_digit_years(spark, short, full):
    assert one(spark, short, lambda c: quality.year_column(c, two_digit=True), "int") == date(full, 1, 1)
    assert one(spark, short, lambda c: quality.year_column(c, False, True), "int") == full


def test_numbers(spark):
    assert one(spark, " 12.5 ", quality.to_number) == 12.5
    assert one(spark, "", quality.to_number) == 0.0
    assert one(spark, "abc", quality.to_number) is None
    for text, whole in (("12.7", 12), ("-12.7", -12), ("1e3", 1000), ("42", 42), ("3e9", None)):
        assert one(spark, text, lambda c: quality.to_number(c, to="int")) == whole
    assert one(spark, "9007199254740993", lambda c: quality.to_number(c, to="bigint")) == 9007199254740993
    assert one(spark, None, quality.to_number) is None
    with pytest.raises(Exception, match="empty text"):
        one(spark, " ", lambda c: quality.to_number(c, empty_as_zero=False))


def test_checked_cast(spark):
    assert one(spark, 127, lambda c: quality.checked_cast(c, "tinyint"), "int") == 127
    assert one(spark, 128, lambda c: quality.checked_cast(c, "tinyint", "null"), "int") is None
    with pytest.raises(Exception, match="out of range for tinyint: 128"):
        one(spark, 128, lambda c: quality.checked_cast(c, "tinyint"), "int")
    frame = spark.createDataFrame([(1,), (300,), (None,)], "x int")
    assert rows(quality.cast_rejects(frame, "x", "tinyint")) == [(300,)]


def test_tiny_to_bool(spark):
    frame = spark.createDataFrame([(0,), (1,), (-1,), (None,)], "x tinyint")
    assert [r.x for r in quality.tiny_to_bool(frame, ["x"]).collect()] == [False, True, True, None]


@pytest.mark.parametrize(
    "value, pattern, expected",
    [
        ("Hello", "h%o", True), ("Hello", "h_llo", True), ("Hello", "h_lo", False), ("Hello", "hello", True),
        ("50%", r"50\%", True), ("501", r"50\%", False), ("a_b", r"a\_b", True), ("axb", r"a\_b", False),
        ("", "%", True), ("", "_", False), ("x\ny", "x%y", True), ("abc", r"a\bc", True), (None, "%", False),
        ("aXbXc", "a%x%c", True), ("abc", "abc_", False), ("a\\b", r"a\\b", True),
        ("a\\", "a\\", True),
    ],
)
def test_wild_match(spark, value, pattern, expected):
    assert one(spark, value, lambda c: quality.wild_match(c, pattern)) is expected


def test_shift_tz(spark):
    summer = datetime(2024, 7, 1, 12)
    assert one(spark, summer, lambda c: quality.shift_tz(c, "UTC", "America/Toronto"), "timestamp_ntz") == datetime(2024, 7, 1, 8)


def test_regex_guard(spark):
    frame = spark.createDataFrame([(1, "ok", "4111"), (2, "4111", None), (3, "x4111", "ok")], "id int, a string, b string")
    assert rows(quality.regex_guard(frame, r"\d+", "drop").select("id")) == [(3,)]
    assert rows(quality.regex_report(frame, r"\d+", ["id"])) == [(1, "b"), (2, "a")]
    assert rows(quality.regex_guard(frame, r"\d+", "flag").select("id", "disallowed")) == [(1, ["b"]), (2, ["a"]), (3, [])]
    assert quality.regex_guard(frame, "never").count() == 3
    with pytest.raises(Exception, match="value disallowed in column"):
        quality.regex_guard(frame, r"\d+").collect()
    with pytest.raises(ValueError):
        quality.regex_guard(frame, r"\d+", "other")
    assert rows(quality.regex_report(frame, "[23]", ["id"], cols=["id"])) == [(2, "id"), (3, "id")]
    with pytest.raises(Exception, match="value disallowed in column id"):
        quality.regex_guard(frame, "3", cols=["id"]).collect()


def test_convert(spark):
    assert one(spark, "12", lambda c: quality.convert(c, "sql_integer")) == 12
    assert one(spark, "2024-01-02", lambda c: quality.convert(c, "DATE")) == date(2024, 1, 2)
    assert one(spark, "01:02:03", lambda c: quality.convert(c, "TIME")) == 3723
    assert one(spark, "x", lambda c: quality.convert(c, "DOUBLE", strict=False)) is None
    with pytest.raises(ValueError):
        quality.convert(F.lit(1), "GEOMETRY")


def test_row_changes(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    changes = spark.createDataFrame(
        [(2, "x", "update", 1), (2, "y", "update", 2), (3, None, "delete", 3), (4, "d", "insert", 4),
         (5, "e", "insert", 5), (5, None, "delete", 6), (1, None, "update", 7)],
        "id int, v string, op string, n int",
    )
    found = endpoints.apply_changes(base, changes, ["id"], "op", ["n"])
    assert rows(found) == [(1, None), (2, "y"), (4, "d")]
    with pytest.raises(ValueError, match="primary key"):
        endpoints.apply_changes(base, changes, ["id", "other"], "op", ["n"])
    with pytest.raises(ValueError, match="primary key"):
        endpoints.apply_changes(base, changes, [], "op", ["n"])


def test_endpoints_of_a_route_whose_trip_has_no_stops(spark):
    trips = spark.createDataFrame([(1, 10), (2, 10), (3, 10), (4, 11)], "trip_id bigint, station_id bigint")
    times = spark.createDataFrame([(1, 2, 6), (1, 1, 5), (3, 1, 5), (3, 9, 7)], "trip_id bigint, stop_sequence int, stop_id bigint")
    stops = spark.createDataFrame([(5, 1.0, 2.0), (6, 3.0, 4.0), (7, 5.0, 6.0)], "stop_id bigint, stop_lat double, stop_lon double")
    found = endpoints.route_endpoints(trips, times, stops)
    assert rows(found) == [(10, 1.0, 2.0, 5.0, 6.0), (11, None, None, None, None)]
    old = spark.createDataFrame([(10, "a", 0.0, 0.0, 0.0, 0.0), (11, "b", 9.0, 9.0, 9.0, 9.0)],
                                "station_id int, station_name string, start_lat double, start_lon double, end_lat double, end_lon double")
    assert rows(endpoints.update_endpoints(old, found)) == [(10, "a", 1.0, 2.0, 5.0, 6.0), (11, "b", 9.0, 9.0, 9.0, 9.0)]


@pytest.mark.parametrize(
    "column, expected",
    [
        (lambda: named.truncate(F.lit(1.999), 2), 1.99), (lambda: named.truncate(F.lit(-1.999), 0), -1.0),
        (lambda: named.truncate(F.lit(129.0), -1), 120.0),
        (lambda: named.truncate(F.lit(0.29), 2), 0.29), (lambda: named.truncate(F.lit(-4.35), 2), -4.35),
        (lambda: named.truncate(F.lit(1e19), 0), 1e19), (lambda: named.truncate(F.lit(1e22), 3), 1e22),
        (lambda: named.length(F.lit("é")), 2), (lambda: named.elt(F.lit(2), F.lit("a"), F.lit("b")), "b"),
        (lambda: named.elt(F.lit(3), F.lit("a"), F.lit("b")), None),
        (lambda: named.field(F.lit("c"), F.lit("a"), F.lit("c")), 2), (lambda: named.field(F.lit("z"), F.lit("a")), 0),
        (lambda: named.make_set(F.lit(5), F.lit("a"), F.lit("b"), F.lit("c")), "a,c"),
        (lambda: named.make_set(F.lit(7), F.lit("a"), F.lit(None), F.lit("c")), "a,c"),
        (lambda: named.export_set(F.lit(6), "1", "0", ",", 5), "0,1,1,0,0"),
        (lambda: named.insert(F.lit("Quadratic"), 3, 4, F.lit("What")), "QuWhattic"),
        (lambda: named.insert(F.lit("Quadratic"), -1, 4, F.lit("What")), "Quadratic"),
        (lambda: named.insert(F.lit("Quadratic"), 3, 100, F.lit("What")), "QuWhat"),
        (lambda: named.mid(F.lit("Quadratic"), 5, 3), "rat"), (lambda: named.oct(F.lit(12)), "14"),
        (lambda: named.ord(F.lit("2")), 50), (lambda: named.ord(F.lit("é")), 50089), (lambda: named.ord(F.lit("")), 0),
        (lambda: named.strcmp(F.lit("a"), F.lit("b")), -1), (lambda: named.strcmp(F.lit("b"), F.lit("b")), 0),
        (lambda: named.period_add(F.lit(200801), F.lit(2)), 200803), (lambda: named.period_add(F.lit(9911), F.lit(3)), 200002),
        (lambda: named.period_diff(F.lit(200802), F.lit(200703)), 11),
        (lambda: named.to_days(F.lit("2007-10-07").cast("date")), 733321),
        (lambda: named.from_days(F.lit(730669)), date(2000, 7, 3)),
        (lambda: named.week(F.lit("2008-02-20").cast("date")), 7), (lambda: named.week(F.lit("2008-01-01").cast("date")), 0),
        (lambda: named.week(F.lit("2008-02-20").cast("date"), 3), 8),
        (lambda: named.dayname(F.lit("2007-02-03").cast("date")), "Saturday"),
        (lambda: named.monthname(F.lit("2008-02-03").cast("date")), "February"),
        (lambda: named.sec_to_time(F.lit(2378)), "00:39:38"), (lambda: named.sec_to_time(F.lit(-400000)), "-111:06:40"),
        (lambda: named.time_to_sec(F.lit("22:23:00")), 80580), (lambda: named.time_to_sec(F.lit("-00:39:38")), -2378),
        (lambda: named.time_to_sec(F.lit("noon")), None), (lambda: named.time_to_sec(F.lit("10:30")), 37800),
        (lambda: named.time_format(F.lit(360000), "%H %k %h %I %l"), "100 100 04 04 4"),
        (lambda: named.percent_format(F.lit("2009-10-04 22:23:00").cast("timestamp_ntz"), "%W %M %Y %%"), "Sunday October 2009 %"),
        (lambda: time.parse_ts(F.lit("2024-02-30 00:00:00")), None),
        (lambda: time.parse_ts(F.lit("2024-02-29 01:02:03")), datetime(2024, 2, 29, 1, 2, 3)),
        (lambda: time.hour_bucket(F.lit("2024-02-29 23:59:59").cast("timestamp_ntz")), 20),
        (lambda: time.interval_label(F.lit("2024-02-29 23:00:00").cast("timestamp_ntz"), "1 hour"), "23:00 - 00:00"),
        (lambda: time.padded_hour(F.lit("2024-02-29 03:00:00").cast("timestamp_ntz")), "03"),
    ],
)
def test_named_functions(spark, column, expected):
    assert spark.range(1).select(column()).first()[0] == expected


def test_times_do_not_pass_through_the_session_zone(spark):
    """02:30 does not exist on that day in that zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ts = F.lit("2024-03-10 02:30:15.5").cast("timestamp_ntz")
        found = spark.range(1).select(
            time.interval_label(ts, "1 hour"), time.time_text(ts), time.hour_start(ts), time.hour_bucket(ts, 2),
            micros_between(ts, ts + F.expr("INTERVAL 1 DAY")), window_of(ts, "1 hour")["start"],
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    hour = datetime(2024, 3, 10, 2)
    assert tuple(found) == ("02:30 - 03:30", "2024-03-10 02:30:15", hour, 2, 86_400_000_000, hour)


def test_clock_functions(spark):
    text, stamp = spark.range(1).select(named.curtime(), named.sysdate()).first()
    assert len(text) == 8 and isinstance(stamp, datetime)


def test_strict_parse(spark):
    with pytest.raises(Exception, match="not a time"):
        one(spark, "yesterday", lambda c: time.parse_ts(c, strict=True))


def test_numbers_become_plain_text(spark):
    frame = spark.createDataFrame([(12345678.9, "1E7"), (0.0001, "x"), (10.5, None), (None, "")], "v double, t string")
    found = frame.select(quality.convert(F.col("v"), "VARCHAR").alias("v"), quality.convert(F.col("t"), "CHAR").alias("t"))
    assert [tuple(r) for r in found.collect()] == [("12345678.9", "1E7"), ("0.0001", "x"), ("10.5", None), (None, "")]


def test_decimals_keep_the_digits_asked_for(spark):
    frame = spark.createDataFrame([("0.123456789012",)], "t string")
    assert str(frame.select(quality.convert(F.col("t"), "DECIMAL(20,12)")).first()[0]) == "0.123456789012"


def test_a_density_chart_over_its_limit_is_an_error(spark):
    with pytest.raises(ValueError, match="longer"):
        charts.density(spark.range(0), "2024-01-01", "2024-01-03", longest="1 day")


def test_plain_number_texts_hold_the_value(spark):
    """No digit is lost to the places of a decimal."""
    numbers = [1.0e-20, -1.0e-20, 1.2345e-15, 1.2345678901234567e-4, 1.5e-10, -2.5e7, 1.0e19, 1.0e300, 5e-324]
    found = spark.createDataFrame([(x,) for x in numbers], "v double").select(quality.convert(F.col("v"), "VARCHAR")).collect()
    assert [float(r[0]) for r in found] == numbers
    assert [r[0] for r in found][:7] == ["1.0E-20", "-1.0E-20", "1.2345E-15", "1.2345678901234567E-4", "0.00000000015", "-25000000.0", "10000000000000000000.0"]
    assert spark.createDataFrame([(1.0e-20,)], "v float").select(quality.convert(F.col("v"), "VARCHAR")).first()[0] == "1.0E-20"


def test_week_modes(spark):
    """Published examples, and a count by hand over the turns of many years."""
    def by_hand(day, mode):
        start = 0 if mode % 2 else 6  # weekday() of a week's first day
        opening = lambda d: d - timedelta(days=(d.weekday() - start) % 7)

        def first_week(year):
            first = opening(date(year, 1, 1))
            inside = 7 - (date(year, 1, 1) - first).days
            begins = inside >= 4 if mode in (1, 3, 4, 6) else inside == 7
            return first if begins else first + timedelta(days=7)

        weeks = (opening(day) - first_week(day.year)).days // 7 + 1
        if mode in (0, 1, 4, 5):
            return max(weeks, 0)
        if weeks < 1:
            return (opening(day) - first_week(day.year - 1)).days // 7 + 1
        return 1 if opening(day) >= first_week(day.year + 1) else weeks

    days = [date(y, m, d) for y in range(1996, 2030) for m, d in [(1, k) for k in range(1, 12)] + [(12, k) for k in range(20, 32)] + [(2, 29 if y % 4 == 0 else 28)]]
    frame = spark.createDataFrame([(d,) for d in days], "day date")
    for row in frame.select("day", *[named.week(F.col("day"), m).alias(f"m{m}") for m in range(8)]).collect():
        assert tuple(row)[1:] == tuple(by_hand(row.day, m) for m in range(8)), row
    known = {(date(2008, 2, 20), 0): 7, (date(2008, 2, 20), 1): 8, (date(2008, 12, 31), 1): 53, (date(2000, 1, 1), 0): 0, (date(2000, 1, 1), 2): 52}
    for (day, mode), want in known.items():
        assert spark.createDataFrame([(day,)], "day date").select(named.week(F.col("day"), mode)).first()[0] == want
    with pytest.raises(ValueError):
        named.week(F.col("day"), 8)
