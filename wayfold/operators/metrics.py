"""Durations: summaries, histograms, error margins, throughput, slow and abnormal values."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, Window, functions as F

from wayfold.plans.joins import join_stats
from wayfold.plans.timing import micros_between, window_of

# Histogram buckets and the stretch of their width.
BUCKETS = 20
STRETCH = 1.25
BAR = 20

# Slow threshold in milliseconds; sigmas and rows needed to call a value abnormal.
SLOW_MS = 2000
ABNORMAL_SIGMAS = 5.0
ABNORMAL_ROWS = 15

# Two-sided quantiles of the normal distribution.
NORMAL = {95: 1.959963984540054, 99: 2.5758293035489004}

# Two-sided Student t, indexed by number of runs minus one, and the interval width.
T_TABLE = {
    95: (
        12.706, 4.303, 3.182, 2.776, 2.571, 2.447, 2.365, 2.306, 2.262, 2.228,
        2.201, 2.179, 2.160, 2.145, 2.131, 2.120, 2.110, 2.101, 2.093, 2.086,
        2.080, 2.074, 2.069, 2.064, 2.060, 2.056, 2.052, 2.048, 2.045, 2.042,
    ),
    99: (
        63.657, 9.925, 5.841, 4.604, 4.032, 3.707, 3.499, 3.355, 3.250, 3.169,
        3.106, 3.055, 3.012, 2.977, 2.947, 2.921, 2.898, 2.878, 2.861, 2.845,
        2.831, 2.819, 2.807, 2.797, 2.787, 2.779, 2.771, 2.763, 2.756, 2.750,
    ),
}
INTERVAL_WIDTH = 0.1


def duration_summary(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.max(value).alias("longest"),
        F.min(value).alias("shortest"),
        F.avg(value).alias("average"),
        F.count(value).alias("count"),
    )


def moments(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Partial statistics per group, one row each, that :func:`merge_moments` adds up: ``n``, ``mean``, ``m2`` (squared distances
    from the mean), ``lowest`` and ``highest``. Kept per day, they let a long range read days and not rows."""
    v = F.col(value).cast("double")
    found = df.groupBy(*by).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.var_pop(v).alias("__var"), F.min(v).alias("lowest"), F.max(v).alias("highest")
    )
    m2 = F.when(F.col("n") == 1, F.lit(0.0)).otherwise(F.col("__var") * F.col("n"))
    return found.where("n > 0").select(*by, "n", "mean", m2.alias("m2"), "lowest", "highest")


def merge_moments(partials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same columns for coarser groups. All sums are of distances from one partial mean of the group, so that large values
    lose no digits; that mean comes from a first aggregate, and both fold map side."""
    by = list(by)
    centres = partials.groupBy(*by).agg(F.min("mean").alias("__c"))
    if by:
        beside = join_stats(partials, centres, by)
    else:
        beside = partials.withColumn("__c", centres.scalar())
    off = F.col("mean") - F.col("__c")
    sums = beside.groupBy(*by).agg(
        F.sum("n").alias("n"), F.min("__c").alias("__c"), F.sum(F.col("n") * off).alias("__s"),
        F.sum(F.col("m2") + F.col("n") * off * off).alias("__q"), F.min("lowest").alias("lowest"), F.max("highest").alias("highest"),
    ).where("n > 0")
    apart = F.col("__s") / F.col("n")
    m2 = F.greatest(F.col("__q") - F.col("__s") * apart, F.lit(0.0))
    return sums.select(*by, "n", (F.col("__c") + apart).alias("mean"), m2.alias("m2"), "lowest", "highest")


def summary_of(found: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """:func:`duration_summary` from moments."""
    return found.select(*by, F.col("highest").alias("longest"), F.col("lowest").alias("shortest"), F.col("mean").alias("average"), F.col("n").alias("count"))


def histogram20(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact histogram: ``bucket``, its ``breakpoint``, the ``count``, and a star ``bar``.

    Breakpoints begin at the minimum, 1.25/20 of the range apart but at least 1; a value falls in
    the first bucket whose breakpoint is not below it. The bounds are a first aggregate: of a whole table one row, a
    scalar subquery; with groups a row each, joined as any dimension. Each task then counts into a vector of 20 per
    group, so neither aggregate shuffles values, and empty buckets need no join.
    """
    by, v = list(by), F.col("__v")
    values = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("__v"))
    width = F.greatest(F.lit(1.0), (F.max(v) - F.min(v)) / F.lit(BUCKETS) * F.lit(STRETCH))
    bounds = values.groupBy(*by).agg(F.min(v).alias("__lo"), width.alias("__w"))
    if by:
        placed = join_stats(values, bounds, by)
    else:
        placed = values.withColumn("__b", bounds.select(F.struct("__lo", "__w")).scalar()).select("*", "__b.*").drop("__b")
    step = F.least(F.ceil((v - F.col("__lo")) / F.col("__w")), F.lit(BUCKETS - 1)).cast("int")
    placed = placed.withColumn("__step", step)
    vector = F.array(*[F.count_if(F.col("__step") == n) for n in range(BUCKETS)])
    counts = placed.groupBy(*by).agg(F.min("__lo").alias("__lo"), F.min("__w").alias("__w"), vector.alias("__counts")).where("__lo IS NOT NULL")
    filled = counts.select("*", F.posexplode("__counts").alias("bucket", "count"))
    highest = F.greatest(F.array_max("__counts"), F.lit(1))
    stars = F.floor(F.lit(float(BAR)) * (F.col("count") / highest)).cast("int")
    breakpoint_ = F.col("__lo") + F.col("bucket") * F.col("__w")
    return filled.select(*by, "bucket", breakpoint_.alias("breakpoint"), "count", F.repeat(F.lit("*"), stars).alias("bar"))


def margin_of_error(
    df: DataFrame, value: str, by: Sequence[str] = (), level: int = 95,
    interval_width: float = INTERVAL_WIDTH,
) -> DataFrame:
    """Mean, population sigma, margin of error and confidence value per group of runs.

    Beyond the table, which ends at 30 runs, the quantile is its expansion round the normal one.
    """
    stats = df.groupBy(*by).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("stdevp")
    )
    return _margins(stats, by, level, interval_width)


def margin_of(found: DataFrame, by: Sequence[str] = (), level: int = 95, interval_width: float = INTERVAL_WIDTH) -> DataFrame:
    """:func:`margin_of_error` from moments."""
    return _margins(found.withColumn("stdevp", F.sqrt(F.col("m2") / F.col("n"))), by, level, interval_width)


def _margins(stats: DataFrame, by: Sequence[str], level: int, interval_width: float) -> DataFrame:
    if level not in T_TABLE:
        raise ValueError("level must be 95 or 99")
    table = F.array(*[F.lit(t) for t in T_TABLE[level]])
    n = F.col("n")
    z, free = NORMAL[level], n.cast("double")
    beyond = F.lit(z) + F.lit((z**3 + z) / 4) / free + F.lit((5 * z**5 + 16 * z**3 + 3 * z) / 96) / (free * free)
    size = F.lit(len(T_TABLE[level]))
    t = F.when(n <= size, F.element_at(table, F.least(n, size).cast("int"))).otherwise(beyond)
    doubt = F.lit(2.0) * t * F.col("stdevp") / F.sqrt(n - F.lit(1.0)) / F.nullif(F.col("mean"), F.lit(0.0))
    return stats.where(n > 0).select(
        *by, "n", "mean", "stdevp",
        (t * (F.col("stdevp") / F.sqrt(n))).alias("margin"),
        F.when(n > 1, F.lit(interval_width) - doubt).alias("confidence"),
    )


def throughput(
    df: DataFrame, started: str, ended: str, rows: str, by: Sequence[str] = ()
) -> DataFrame:
    """Queries and rows per second over the whole span, and mean execution time in seconds."""
    each = micros_between(F.col(started), F.col(ended))
    sums = df.groupBy(*by).agg(
        F.count("*").alias("queries"),
        F.sum(rows).alias("rows"),
        F.sum(each).alias("__busy"),
        micros_between(F.min(started), F.max(ended)).alias("__span"),
    )
    seconds = F.nullif(F.col("__span"), F.lit(0)) / F.lit(1e6)
    return sums.select(
        *by, "queries", "rows",
        (F.col("queries") / seconds).alias("queries_per_s"),
        (F.col("rows") / seconds).alias("rows_per_s"),
        (F.col("__busy") / F.col("queries") / F.lit(1e6)).alias("mean_s"),
    )


def slow(df: DataFrame, value: str, limit: float = SLOW_MS) -> DataFrame:
    return df.where(F.col(value) > F.lit(limit))


def abnormal(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str,
    k: float = ABNORMAL_SIGMAS, min_n: int = ABNORMAL_ROWS,
    slice_width: str | timedelta = timedelta(minutes=1),
) -> DataFrame:
    """Rows whose value is above mean + k sigma of the earlier values of their group.

    ``order`` starts with a timestamp and makes the order unique. A running frame over a whole
    group would put a hot group in one task, so time is sliced. Each slice begins with one row that
    holds the sums of all earlier slices, and the running sums go on from there. All sums are of
    distances from the mean of the group's first slice, so that large values lose no digits.
    """
    by, v = list(by), F.col(value).cast("double")
    sliced = df.withColumn("__slice", window_of(order[0], slice_width)["start"])
    moments = sliced.groupBy(*by, "__slice").agg(
        F.count(v).alias("__n"), F.avg(v).alias("__m"), (F.var_pop(v) * F.count(v)).alias("__m2")
    )
    in_time = Window.partitionBy(*by).orderBy("__slice")
    whole = in_time.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    off = F.col("__m") - F.col("__c")
    slices = moments.withColumn("__c", F.first("__m", ignorenulls=True).over(whole)).select(
        *by, "__slice", "__c", "__n", (F.col("__n") * off).alias("__s"), (F.col("__m2") + F.col("__n") * off * off).alias("__q")
    )
    sums = ("__n", "__s", "__q")
    earlier = in_time.rowsBetween(Window.unboundedPreceding, -1)
    heads = slices.select(*by, "__slice", "__c", *[F.sum(c).over(earlier).alias(c) for c in sums])
    merged = sliced.withColumn("__row", F.lit(1)).unionByName(heads.withColumn("__row", F.lit(0)), allowMissingColumns=True)

    in_slice = Window.partitionBy(*by, "__slice").orderBy("__row", *order)
    running = in_slice.rowsBetween(Window.unboundedPreceding, -1)
    far = v - F.first("__c", ignorenulls=True).over(in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    own = merged.withColumn("__v", F.when(F.col("__row") == 1, far)).withColumns({
        "__n": F.when(F.col("__row") == 1, F.col("__v").isNotNull().cast("bigint")).otherwise(F.col("__n")),
        "__s": F.coalesce("__v", "__s"), "__q": F.coalesce(F.col("__v") * F.col("__v"), "__q"),
    })
    totals = own.withColumns({f"{c}_before": F.sum(c).over(running) for c in sums})
    n, total, squares = (F.col(f"{c}_before") for c in sums)
    mean = total / n
    spread = F.greatest(squares - total * mean, F.lit(0.0)) / (n - F.lit(1))
    limit = F.when(n >= F.lit(min_n), mean + F.lit(k) * F.sqrt(spread))
    return totals.where((F.col("__row") == 1) & (F.col("__v") > limit)).select(*df.columns)


def numeric_diff(before: DataFrame, after: DataFrame, key: str, val: str) -> DataFrame:
    """Change of every numeric value between two key/value tables; unchanged keys are left out."""
    old = before.select(key, F.col(val).try_cast("double").alias("__old"))
    new = after.select(key, F.col(val).try_cast("double").alias("__new"))
    change = F.col("__new") - F.col("__old")
    return old.join(new, key).select(key, change.alias("change")).where(F.col("change") != 0)
