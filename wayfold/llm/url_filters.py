"""URL filters by a temporal list join.

A list is a log of dated entries (pattern, action 'add' or 'remove', at). Per pattern the log becomes
validity intervals [from, to): an add opens one, the next remove closes it; entries that change
nothing are passed over. A pattern is a host ('a.example.com', which holds its subdomains too) or a
host and the start of a path up to a '/' ('a.example.com/x/'), of any depth.

Every capture is cut to the few keys that could match it: its host and parent domains, and its host
with each leading part of the path, as deep as the list's deepest pattern. The as-of join meets keys and intervals by equality of the
pattern and keeps those open at the fetch time. Captures of a hot host are salted: their keys are dealt to
SALTS groups and the (much smaller) list is repeated in each, so no task gets all of a host.

Defined cases: a null or empty url, or one without a host, matches nothing; a null fetch time
matches nothing; host letters are compared in lower case, ports, user names and a final dot are
dropped; on equal times a remove comes after an add; repeated captures are judged once and given back as often as
they came, repeated entries count once; entries with a null field are passed over; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

SALTS = 16


def host(url: Column) -> Column:
    """Lower-case host of an http(s) URL, '' if there is none."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?i:https?)://([^/?#]*)", 1)
    bare = F.regexp_replace(F.regexp_replace(rest, r"^.*@", ""), r":\d*$", "")
    return F.lower(F.regexp_replace(bare, r"\.$", ""))


def depth_of(log: DataFrame) -> int:
    """The most leading parts of a path that any pattern of the list names."""
    return max(0, log.agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0)


def keys(url: Column, deepest: int) -> Column:
    """Every pattern of at most ``deepest`` leading parts of a path that matches the URL."""
    name = host(url)
    labels = F.split(name, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?i:https?)://[^/?#]*(/[^?#]*)", 1)
    parts = F.split(path, "/")
    depth = F.least(F.size(parts) - 1, F.lit(deepest))
    paths = F.when(depth < 1, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(depth, F.lit(1))), lambda i: F.concat(name, F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")))
    )
    return F.when(name == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(domains, paths)))


def intervals(log: DataFrame) -> DataFrame:
    """(pattern, valid_from, valid_to or null) from the log."""
    rows = log.select("pattern", "action", "at").where("pattern IS NOT NULL AND at IS NOT NULL AND action IN ('add', 'remove')").distinct()
    order = Window.partitionBy("pattern").orderBy("at", "action")
    changed = rows.withColumn("before", F.lag("action", 1, "remove").over(order)).where("action <> before")
    # An add and a remove of one time leave an interval of no length, which holds no time.
    closed = changed.withColumn("valid_to", F.lead("at").over(order)).where("action = 'add'")
    return closed.select("pattern", F.col("at").alias("valid_from"), "valid_to")


def judge(captures: DataFrame, log: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """(id, url, fetched, n_entries, pattern, blocked) of every capture: the number of entries active at
    its fetch time that match, and the longest of them (the first in order, if several are as long)."""
    salt = F.lit(SALTS)
    deepest = depth_of(log)
    shots = captures.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"), F.col(time_col).alias("__at"))
    own = ["__id", "__url", "__at", "__times"]
    shots = shots.groupBy("__id", "__url", "__at").agg(F.count("*").cast("int").alias("__times"))
    offered = shots.withColumn("pattern", F.explode_outer(keys(F.col("__url"), deepest))).withColumn("salt", F.pmod(F.xxhash64(*own[:3]), salt))
    entries = intervals(log).withColumn("group", F.explode(F.sequence(F.lit(0).cast("bigint"), (salt - 1).cast("bigint"))))
    entries = entries.withColumnRenamed("pattern", "listed")
    active = (
        (F.col("pattern") == F.col("listed")) & (F.col("salt") == F.col("group"))
        & (F.col("__at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("__at") < F.col("valid_to")))
    )
    met = offered.join(entries, active, "left")
    longest = F.min(F.when(F.col("listed").isNotNull(), F.struct((-F.length("listed")).alias("l"), F.col("listed").alias("p"))))["p"]
    out = met.groupBy(*own).agg(F.count_distinct("listed").alias("n_entries"), longest.alias("pattern"))
    out = out.withColumn("one", F.explode(F.array_repeat(F.lit(1), F.col("__times"))))
    return out.select(
        F.col("__id").alias(id_col), F.col("__url").alias(url_col), F.col("__at").alias(time_col), "n_entries", "pattern",
        (F.col("n_entries") > 0).alias("blocked"),
    )
