"""Placement, value cleaning, guards, conversions, named functions."""

from pyspark.sql import functions as F

from wayfold.functions import named
from wayfold.operators import placement, quality
from wayfold.sources.writers import shared_dir
from wayfold.suite.registry import case
from wayfold.suite.views import table

RANGE_BOUNDS = [(1, "shard_group_0"), (10000, "shard_group_1"), (1001, "shard_group_2"),
                (400, "shard_group_3"), (1000, "shard_group_4"), (470, "shard_group_5"),
                (10**9, "shard_group_6")]
HASH_BOUNDS = [("A" * 32, "server_group_0"), ("6" * 32, "server_group_1"),
               ("2809A05A22A4A9C1882A580BCC0AD8A6", "server_group_2"), ("D" * 32, "server_group_3")]

RANGE_SQL = """CASE WHEN {0} >= 1000000000 THEN 'shard_group_6' WHEN {0} >= 10000 THEN 'shard_group_1'
    WHEN {0} >= 1001 THEN 'shard_group_2' WHEN {0} >= 1000 THEN 'shard_group_4' WHEN {0} >= 470 THEN 'shard_group_5'
    WHEN {0} >= 400 THEN 'shard_group_3' WHEN {0} >= 1 THEN 'shard_group_0' END"""
HASH_SQL = f"""(SELECT coalesce(max_by(g, b) FILTER (b <= upper(md5({{0}}))), max_by(g, b))
    FROM (VALUES {', '.join(f"('{b}', '{g}')" for b, g in HASH_BOUNDS)}) bounds(b, g))"""


@case(
    "place_range",
    f'SELECT o_orderkey, coalesce({RANGE_SQL.format("o_orderkey")}, \'none\') AS "group" FROM orders',
)
def _(spark, sf):
    """Key 0 lies under the lowest bound."""
    placed = placement.place_range(table(spark, sf, "orders"), "o_orderkey", RANGE_BOUNDS)
    return placed.select("o_orderkey", F.coalesce("group", F.lit("none")).alias("group"))


@case("place_hash", f'SELECT c_custkey, c_name, {HASH_SQL.format("c_name")} AS "group" FROM customer')
def place_hash(spark, sf):
    placed = placement.place_hash(table(spark, sf, "customer"), "c_name", HASH_BOUNDS)
    return placed.select("c_custkey", "c_name", "group")


@case(
    "place_range_by",
    """WITH bounds AS (SELECT o_orderkey AS bound, 'g' || o_custkey AS "group" FROM orders WHERE o_orderkey % 3 = 1)
       SELECT l_orderkey, count(*) AS items, "group" FROM (
           SELECT l_orderkey, b."group" FROM lineitem l ASOF LEFT JOIN bounds b ON l.l_orderkey >= b.bound)
       GROUP BY ALL""",
)
def _(spark, sf):
    """A third of all order keys are bounds, so their number grows with the table."""
    bounds = table(spark, sf, "orders").where("o_orderkey % 3 = 1")
    bounds = bounds.select(F.col("o_orderkey").alias("bound"), F.concat(F.lit("g"), "o_custkey").alias("group"))
    placed = placement.place_range_by(table(spark, sf, "lineitem").select("l_orderkey"), "l_orderkey", bounds)
    return placed.groupBy("l_orderkey", "group").agg(F.count("*").alias("items"))


@case(
    "place_hash_by",
    """WITH bounds AS (SELECT upper(md5(s_suppkey::VARCHAR)) AS bound, 's' || s_suppkey AS "group" FROM supplier)
       SELECT c_custkey, c_name, coalesce(b."group", (SELECT arg_max("group", bound) FROM bounds)) AS "group"
       FROM (SELECT *, upper(md5(c_name)) AS h FROM customer) c ASOF LEFT JOIN bounds b ON c.h >= b.bound""",
)
def _(spark, sf):
    """A ring with a place for every supplier."""
    key = F.col("s_suppkey").cast("string")
    bounds = table(spark, sf, "supplier").select(F.upper(F.md5(key)).alias("bound"), F.concat(F.lit("s"), key).alias("group"))
    return placement.place_hash_by(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_name", bounds)


@case(
    "write_placed",
    f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'global'
               ELSE {HASH_SQL.format("CAST(o_custkey AS VARCHAR)")} END AS "group" FROM orders""",
)
def _(spark, sf):
    """Orders in status P have no key here."""
    path = shared_dir(spark, "placed")
    orders = table(spark, sf, "orders").withColumn("key", F.expr("if(o_orderstatus = 'P', null, o_custkey)"))
    placement.write_placed(orders, path, "key", HASH_BOUNDS)
    return spark.read.parquet(path).select("o_orderkey", F.col("group").cast("string").alias("group"))


@case(
    "placement_counts",
    f"""SELECT "group", coalesce(n, 0) AS rows
        FROM (SELECT 'shard_group_' || unnest(range(7)) AS "group")
        LEFT JOIN (SELECT {RANGE_SQL.format("o_orderkey")} AS "group", count(*) AS n FROM orders GROUP BY 1)
        USING ("group")""",
)
def _(spark, sf):
    """No key reaches the highest bound."""
    placed = placement.place_range(table(spark, sf, "orders"), "o_orderkey", RANGE_BOUNDS)
    return placement.placement_counts(placed, RANGE_BOUNDS)


@case(
    "wild_match",
    r"""SELECT doc_id, text ILIKE '%the%' AS word, text ILIKE '%\%%' ESCAPE '\' AS percent,
               lang ILIKE '_N' ESCAPE '\' AS one, source ILIKE 'SRC1%' ESCAPE '\' AS prefix
        FROM documents""",
)
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        quality.wild_match(F.col("text"), "%The%").alias("word"),
        quality.wild_match(F.col("text"), r"%\%%").alias("percent"),
        quality.wild_match(F.col("lang"), "_N").alias("one"),
        quality.wild_match(F.col("source"), r"S\RC1%").alias("prefix"),
    )


def _dates(spark, sf):
    """Order dates as text, with every kind of zero date among them."""
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    zero = (
        F.when(priority == "1-URGENT", " 0 ").when(priority == "2-HIGH", "0000-00-00")
        .when(priority == "3-MEDIUM", "0000-00-00 00:00:00").otherwise("00000000000000")
    )
    return table(spark, sf, "orders").select("o_orderkey", F.when(status == "P", zero).otherwise(text).alias("day"))


@case(
    "zero_dates_null",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END AS day
       FROM orders""",
)
def _(spark, sf):
    cleaned = quality.zero_dates(_dates(spark, sf), ["day"], "null")
    return cleaned.withColumn("day", F.coalesce(F.col("day").cast("string"), F.lit("")))


@case(
    "zero_dates_round",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '0001-01-01' END AS day
       FROM orders""",
)
def _(spark, sf):
    cleaned = quality.zero_dates(_dates(spark, sf), ["day"], "round")
    return cleaned.withColumn("day", F.col("day").cast("string"))


@case("tiny_to_bool", "SELECT doc_id, quality <> 0 AS quality, toxic <> 0 AS toxic FROM labels")
def _(spark, sf):
    return quality.tiny_to_bool(table(spark, sf, "labels"), ["quality", "toxic"])


@case(
    "year_column",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS SMALLINT) AS full_year,
              CAST(CASE WHEN yy <= 69 THEN yy + 2000 ELSE yy + 1900 END AS SMALLINT) AS short_year,
              strftime(make_date(CASE WHEN yy <= 69 THEN yy + 2000 ELSE yy + 1900 END, 1, 1), '%Y-%m-%d') AS day
       FROM (SELECT *, CAST(o_orderkey % 100 AS INT) AS yy FROM orders)""",
)
def _(spark, sf):
    short = (F.col("o_orderkey") % 100).cast("int")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        quality.year_column(F.year("o_orderdate"), as_date=False).alias("full_year"),
        quality.year_column(short, as_date=False, two_digit=True).alias("short_year"),
        quality.year_column(short, two_digit=True).cast("string").alias("day"),
    )


@case(
    "to_number",
    """SELECT l_orderkey, l_linenumber, l_suppkey,
              CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'R' THEN -1 ELSE l_extendedprice END AS number
       FROM lineitem""",
)
def _(spark, sf):
    """Flag A gives empty texts, flag R texts that are no number."""
    flag, price = F.col("l_returnflag"), F.col("l_extendedprice").cast("string")
    text = F.when(flag == "A", "  ").when(flag == "R", "n/a").otherwise(F.concat(F.lit(" "), price, F.lit(" ")))
    number = F.coalesce(quality.to_number(text), F.lit(-1.0))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", number.alias("number"))


@case(
    "checked_cast",
    """SELECT o_orderkey, coalesce(CASE WHEN trunc(o_totalprice) <= 32767 THEN CAST(trunc(o_totalprice) AS INT) END, -1) AS small,
              CAST(trunc(o_totalprice) AS INT) AS whole
       FROM orders""",
)
def _(spark, sf):
    price = F.col("o_totalprice")
    small = quality.checked_cast(price, "smallint", "null").cast("int")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.coalesce(small, F.lit(-1)).alias("small"),
        quality.checked_cast(price, "int").alias("whole"),
    )


@case("cast_rejects", "SELECT o_orderkey, o_totalprice FROM orders WHERE trunc(o_totalprice) > 32767")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return quality.cast_rejects(orders, "o_totalprice", "smallint")


@case(
    "shift_tz",
    """SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Toronto' AS there,
              (ts AT TIME ZONE 'America/Toronto') AT TIME ZONE 'UTC' AS back
       FROM events""",
)
def _(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id",
        quality.shift_tz(ts, "UTC", "America/Toronto").alias("there"),
        quality.shift_tz(ts, "America/Toronto", "UTC").alias("back"),
    )


MAIL = "(?s).*[a-z0-9]+@[a-z0-9.]+.*"


@case("regex_guard_drop", f"SELECT doc_id, lang, source FROM documents WHERE NOT regexp_full_match(text, '{MAIL}')")
def _(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return quality.regex_guard(documents, MAIL, "drop").select("doc_id", "lang", "source")


@case(
    "regex_guard_flag",
    """SELECT doc_id, CASE WHEN regexp_full_match(lang, 'fr|src1.') THEN 'lang' ELSE '' END
                      || CASE WHEN regexp_full_match(source, 'fr|src1.') THEN 'source' ELSE '' END AS columns
       FROM documents""",
)
def _(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source")
    flagged = quality.regex_guard(documents, "fr|src1.", "flag")
    return flagged.select("doc_id", F.concat_ws("", "disallowed").alias("columns"))


@case(
    "regex_report",
    f"""SELECT doc_id, 'text' AS "column" FROM documents WHERE regexp_full_match(text, '{MAIL}')
        UNION ALL SELECT doc_id, 'source' FROM documents WHERE regexp_full_match(source, '{MAIL}')""",
)
def _(spark, sf):
    return quality.regex_report(table(spark, sf, "documents"), MAIL, ["doc_id"])


@case(
    "convert",
    """SELECT o_orderkey, CAST(o_totalprice AS VARCHAR) AS as_text, CAST(o_orderdate AS VARCHAR)[1:10] AS as_date,
              CAST(o_custkey AS DOUBLE) AS as_double, CAST(o_custkey AS BIGINT) AS as_bigint,
              o_orderdate AS as_timestamp, CAST(o_custkey AS INT) AS as_int,
              CAST(o_custkey % 86400 AS BIGINT) AS as_seconds
       FROM orders""",
)
def _(spark, sf):
    key = F.col("o_custkey")
    key_text, clock = key.cast("string"), named.sec_to_time(key % 86400)
    day = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        quality.convert(F.col("o_totalprice"), "VARCHAR").alias("as_text"),
        quality.convert(day, "SQL_DATE").cast("string").alias("as_date"),
        quality.convert(key_text, "double").alias("as_double"),
        quality.convert(key_text, "BIGINT").alias("as_bigint"),
        quality.convert(day, "SQL_TIMESTAMP").alias("as_timestamp"),
        quality.convert(key_text, "INTEGER").alias("as_int"),
        quality.convert(clock, "TIME").alias("as_seconds"),
    )


@case(
    "numeric_functions",
    """SELECT l_orderkey, l_linenumber, l_suppkey, abs(x) AS abs, round(acos(y), 6) AS acos, round(asin(y), 6) AS asin,
              round(atan(x), 6) AS atan, round(atan2(x, l_quantity), 6) AS atan2, CAST(bit_count(l_suppkey) AS INT) AS bit_count,
              CAST(ceil(x) AS BIGINT) AS ceiling, round(cos(x), 6) AS cos, round(1 / tan(l_quantity), 4) AS cot,
              round(degrees(y), 6) AS degrees, round(exp(y), 6) AS exp, CAST(floor(x) AS BIGINT) AS floor,
              round(ln(l_quantity), 6) AS log, round(log10(l_quantity), 6) AS log10, l_partkey % 7 AS mod,
              round(pi(), 6) AS pi, round(pow(l_quantity, 2), 6) AS pow, round(power(y, 3), 6) AS power,
              round(radians(l_quantity), 6) AS radians, floor(x * 10 + 0.5::DOUBLE) / 10 AS rounded, round(x, 1) AS round, round(sin(x), 6) AS sin,
              round(sqrt(l_quantity), 6) AS sqrt, round(tan(y), 6) AS tan, sign(x) * floor(abs(x) * 10::DOUBLE) / 10::DOUBLE AS truncate,
              sign(x) * floor(abs(x) / 10::DOUBLE) * 10::DOUBLE AS truncate_tens
       FROM (SELECT *, l_quantity - 25.25::DOUBLE AS x, l_discount - l_tax AS y FROM lineitem)""",
)
def _(spark, sf):
    x, y, q = F.col("x"), F.col("y"), F.col("l_quantity")
    lines = table(spark, sf, "lineitem").withColumns(
        {"x": q - F.lit(25.25), "y": F.col("l_discount") - F.col("l_tax")}
    )
    six = {
        "acos": F.acos(y), "asin": F.asin(y), "atan": F.atan(x), "atan2": F.atan2(x, q), "cos": F.cos(x),
        "degrees": F.degrees(y), "exp": F.exp(y), "log": F.ln(q), "log10": F.log10(q), "pi": F.pi(),
        "pow": F.pow(q, F.lit(2)), "power": F.power(y, F.lit(3)), "radians": F.radians(q), "sin": F.sin(x),
        "sqrt": F.sqrt(q), "tan": F.tan(y),
    }
    return lines.select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.abs(x).alias("abs"),
        F.bit_count("l_suppkey").alias("bit_count"), F.ceiling(x).alias("ceiling"), F.floor(x).alias("floor"),
        F.round(F.cot(q), 4).alias("cot"), (F.col("l_partkey") % 7).alias("mod"),
        (F.floor(x * 10 + F.lit(0.5)) / 10).alias("rounded"), F.round(x, 1).alias("round"),
        named.truncate(x, 1).alias("truncate"), named.truncate(x, -1).alias("truncate_tens"),
        *[F.round(value, 6).alias(name) for name, value in six.items()],
    )


@case(
    "string_functions",
    """SELECT p_partkey, CAST(ascii(p_name) AS INT) AS ascii, bin(p_size) AS bin, CAST(8 * length(p_name) AS INT) AS bit_length,
              chr(65 + p_size % 26) AS "char", CAST(length(p_name) AS INT) AS char_length, p_name || '/' || p_brand AS concat,
              concat_ws('-', p_type, p_name) AS concat_ws, CASE p_size % 3 WHEN 1 THEN p_name WHEN 2 THEN p_brand ELSE '' END AS elt,
              CAST(length(p_name) AS INT) AS character_length, to_base(p_partkey, 16) AS conv,
              CAST(strlen(p_name) AS INT) AS length, lower(p_brand) AS lower, CAST(strlen(p_brand) AS INT) AS octet_length,
              upper(p_type) AS upper, CAST(position('i' IN p_name) AS INT) AS position, rtrim(p_name || '  ') AS rtrim,
              CAST(coalesce(list_position(['SMALL', 'ECONOMY'], p_type), 0) AS INT) AS field,
              hex(p_name) AS hex, left(p_name, 2) || p_brand || substr(p_name, 6) AS "insert",
              CAST(instr(p_name, 'i') AS INT) AS instr, lower(p_type) AS lcase, left(p_name, 3) AS "left",
              CAST(position('e' IN p_name) AS INT) AS locate, lpad(p_brand, 10, '*') AS lpad, ltrim('  ' || p_name) AS ltrim,
              array_to_string(list_filter(['a', 'b', 'c'], lambda v, i: (p_size >> (i - 1)) & 1 = 1), ',') AS make_set,
              array_to_string([CASE WHEN (p_size >> i) & 1 = 1 THEN 'Y' ELSE 'N' END FOR i IN range(4)], '|') AS export_set,
              substr(p_name, 2, 4) AS mid, to_base(p_size, 8) AS oct, CAST(ascii(p_name) AS BIGINT) AS ord,
              repeat(p_type, 2) AS repeat, replace(p_name, 'e', 'E') AS replace, reverse(p_name) AS reverse,
              right(p_name, 3) AS "right", rpad(p_brand, 10, '*') AS rpad, repeat(' ', p_size % 4) AS space,
              CAST(CASE WHEN p_name = p_type THEN 0 WHEN p_name < p_type THEN -1 ELSE 1 END AS INT) AS strcmp,
              substr(p_name, 3) AS substring, split_part(p_name, ' ', 1) AS substring_index, trim(' ' || p_name || ' ') AS trim,
              upper(p_name) AS ucase,
              CAST(CASE WHEN p_type = 'ECONOMY' THEN 2 WHEN p_type = 'SMALL' THEN 1 ELSE 0 END AS INT) AS find_in_set,
              '''' || p_name || '''' AS quote,
              CASE p_type WHEN 'ECONOMY' THEN 'E255' WHEN 'LARGE' THEN 'L620' WHEN 'MEDIUM' THEN 'M350' WHEN 'PROMO' THEN 'P650'
                          WHEN 'SMALL' THEN 'S540' WHEN 'STANDARD' THEN 'S353' END AS soundex
       FROM part""",
)
def _(spark, sf):
    name, brand, kind, size = (F.col(f"p_{c}") for c in ("name", "brand", "type", "size"))
    built_in = {
        "ascii": F.ascii(name), "bin": F.bin(size), "bit_length": F.bit_length(name),
        "char": F.char(F.lit(65) + size % 26), "char_length": F.char_length(name),
        "concat": F.concat(name, F.lit("/"), brand), "concat_ws": F.concat_ws("-", kind, name),
        "character_length": F.character_length(name), "conv": F.conv(F.col("p_partkey").cast("string"), 10, 16),
        "lower": F.lower(brand), "octet_length": F.octet_length(brand), "upper": F.upper(kind),
        "position": F.position(F.lit("i"), name), "rtrim": F.rtrim(F.concat(name, F.lit("  "))),
        "hex": F.hex(name), "instr": F.instr(name, "i"), "lcase": F.lcase(kind), "left": F.left(name, F.lit(3)),
        "locate": F.locate("e", name), "lpad": F.lpad(brand, 10, "*"), "ltrim": F.ltrim(F.concat(F.lit("  "), name)),
        "repeat": F.repeat(kind, 2), "replace": F.replace(name, F.lit("e"), F.lit("E")), "reverse": F.reverse(name),
        "right": F.right(name, F.lit(3)), "rpad": F.rpad(brand, 10, "*"), "space": F.expr("space(p_size % 4)"),
        "substring": F.expr("substring(p_name, 3)"), "substring_index": F.substring_index(name, " ", 1),
        "trim": F.trim(F.concat(F.lit(" "), name, F.lit(" "))), "ucase": F.ucase(name),
        "find_in_set": F.find_in_set(kind, F.lit("SMALL,ECONOMY")), "quote": F.quote(name),
        "soundex": F.soundex(kind),
    }
    own = {
        "elt": F.coalesce(named.elt(size % 3, name, brand), F.lit("")), "length": named.length(name),
        "field": named.field(kind, F.lit("SMALL"), F.lit("ECONOMY")), "insert": named.insert(name, 3, 3, brand),
        "make_set": named.make_set(size, F.lit("a"), F.lit("b"), F.lit("c")),
        "export_set": named.export_set(size, "Y", "N", "|", 4), "mid": named.mid(name, 2, 4),
        "oct": named.oct(size), "ord": named.ord(name), "strcmp": named.strcmp(name, kind),
    }
    return table(spark, sf, "part").select(
        "p_partkey", *[value.alias(n) for n, value in (built_in | own).items()]
    )


@case(
    "date_functions",
    """SELECT event_id, CAST(dayofweek(ts) + 1 AS INT) AS dayofweek, CAST(isodow(ts) - 1 AS INT) AS weekday,
              CAST(day(ts) AS INT) AS dayofmonth, CAST(dayofyear(ts) AS INT) AS dayofyear, CAST(month(ts) AS INT) AS month,
              dayname(ts) AS dayname, monthname(ts) AS monthname, CAST(quarter(ts) AS INT) AS quarter,
              CAST(strftime(ts, '%U') AS INT) AS week, CAST(strftime(ts, '%W') AS INT) AS week_monday,
              CAST(week(ts) AS INT) AS week_iso, CAST(year(ts) AS INT) AS year, CAST(hour(ts) AS INT) AS hour,
              CAST(minute(ts) AS INT) AS minute, CAST(second(ts) AS INT) AS second,
              CAST(strftime(CAST(date_trunc('month', ts) AS TIMESTAMP) + INTERVAL 1 MONTH * (event_id % 40), '%Y%m')
                   AS BIGINT) AS period_add,
              CAST((year(ts) - 1999) * 12 + month(ts) - 5 AS BIGINT) AS period_diff,
              CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) + 719528 AS INT) AS to_days,
              strftime(ts, '%Y-%m-%d') AS from_days, strftime(ts, '%d/%m/%y %H:%M') AS date_format,
              strftime(ts, '%H.%M.%S') AS time_format, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS unix_timestamp,
              strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS from_unixtime,
              CASE WHEN event_id % 2 = 0 THEN '' ELSE '-' END
                  || lpad(CAST((event_id * 7) // 3600 AS VARCHAR),
                          CAST(greatest(2, length(CAST((event_id * 7) // 3600 AS VARCHAR))) AS INT), '0')
                  || ':' || lpad(CAST((event_id * 7) // 60 % 60 AS VARCHAR), 2, '0')
                  || ':' || lpad(CAST((event_id * 7) % 60 AS VARCHAR), 2, '0') AS sec_to_time,
              CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT) AS time_to_sec
       FROM events""",
)
def _(spark, sf):
    ts, day = F.col("ts"), F.col("ts").cast("date")
    period = F.date_format(ts, "yyyyMM").cast("int")
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    signed = F.col("event_id") * 7 * F.when(F.col("event_id") % 2 == 0, 1).otherwise(-1)
    fields = {
        "dayofweek": F.dayofweek(ts), "weekday": F.weekday(ts), "dayofmonth": F.dayofmonth(ts),
        "dayofyear": F.dayofyear(ts), "month": F.month(ts), "dayname": named.dayname(ts),
        "monthname": named.monthname(ts), "quarter": F.quarter(ts), "week": named.week(ts),
        "week_monday": named.week(ts, 5), "week_iso": named.week(ts, 3), "year": F.year(ts), "hour": F.hour(ts),
        "minute": F.minute(ts), "second": F.second(ts),
        "period_add": named.period_add(period, F.col("event_id") % 40),
        "period_diff": named.period_diff(period, F.lit(9905)),
        "to_days": named.to_days(day), "from_days": named.from_days(named.to_days(day)).cast("string"),
        "date_format": named.percent_format(ts, "%d/%m/%y %H:%i"),
        "time_format": named.time_format(seconds, "%H.%i.%s"), "unix_timestamp": named.unix_timestamp(ts),
        "from_unixtime": named.from_unixtime(named.unix_timestamp(ts)),
        "sec_to_time": F.when(signed == 0, "00:00:00").otherwise(named.sec_to_time(signed)),
        "time_to_sec": named.time_to_sec(F.date_format(ts, "HH:mm:ss")),
    }
    return table(spark, sf, "events").select("event_id", *[v.alias(n) for n, v in fields.items()])


# The first day of each day's week, counted from Sunday and from Monday.
_FIRSTS = {0: "d - CAST(dayofweek(d) AS INT)", 1: "d - CAST(isodow(d) - 1 AS INT)"}


def _week_sql(mode: int) -> str:
    first, year = _FIRSTS[mode % 2], "date_trunc('year', d)::DATE"
    if mode in (0, 5):
        return f"CAST(strftime(d, '{'%W' if mode else '%U'}') AS INT)"
    if mode in (2, 3, 6, 7):
        decides = f"({first} + {3 if mode in (3, 6) else 0})"
        return f"CAST((dayofyear({decides}) - 1) // 7 + 1 AS INT)"
    opening = first.replace("(d)", f"({year})").replace("d -", f"{year} -", 1)
    return f"CAST(({first} - ({opening})) // 7 + CASE WHEN {year} - ({opening}) <= 3 THEN 1 ELSE 0 END AS INT)"


@case(
    "week_modes",
    f"""SELECT DISTINCT d AS day, {', '.join(f'{_week_sql(m)} AS week_{m}' for m in range(8))}
        FROM (SELECT (o_orderdate + INTERVAL 1 DAY * (o_orderkey % 4000))::DATE AS d FROM orders)""",
)
def _(spark, sf):
    """Days of some eleven years."""
    day = F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 4000).cast("int"))
    days = table(spark, sf, "orders").select(day.alias("day")).distinct()
    return days.select("day", *[named.week(F.col("day"), m).alias(f"week_{m}") for m in range(8)])
