"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted to cells (source, language, topic) with their tokens. Inclusion probabilities
per cell start equal and are raked: each step scales those of one source (language, topic) so that its expected kept tokens
meet their target with no probability over one. Cells that reach one are full and the others are
scaled for the rest: ordered by probability, the first place at which the factor for what is left fits is taken. Cells
stay a distributed table; only its totals go to the driver. Each document is then kept if a hash of its id, taken as a
number between 0 and 1, is under its cell's probability: a rerun keeps the same documents.

Targets are tempered shares: share ** ``temper`` of a marginal's tokens, made to sum to ``budget`` of
all tokens, and at most the tokens that there are; what a value lacks is shared out among the others. ``report`` tells target and
expected tokens of every value; they differ where targets of different marginals exclude each other, or rounds end too soon.

Defined cases: a null source, language or text counts as the value '' ; documents without tokens
have weight but add none; rows with one id share their fate within a cell, a null id hashes as ''; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wayfold.llm.common import kept

#: The topics, each with the marks that a text of it holds, in order of precedence.
TOPICS = (
    ("legal", ("license", "copyright", "rights reserved")),
    ("contact", ("@", "phone", "+1")),
    ("symbols", ("%%%", "$$$", "###", "&&&", "***")),
    ("dialogue", ("?", "!")),
)


def tokens(text: Column) -> Column:
    """Words between blanks."""
    return F.size(F.array_remove(F.split(F.trim(text), r"[\x20\x09-\x0D]+"), "")).cast("bigint")


def topic(text: Column) -> Column:
    """The first topic of which the text holds a mark, else prose."""
    lower = F.lower(text)
    chosen = F.lit("prose")
    for name, marks in reversed(TOPICS):
        found = F.lit(False)
        for mark in marks:
            found = found | F.contains(lower, F.lit(mark))
        chosen = F.when(found, name).otherwise(chosen)
    return chosen


def unit_hash(column: Column) -> Column:
    """A number from 0 (included) to 1 from the first 52 bits of the MD5 of the value as text."""
    text = F.coalesce(column.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def targets_of(cells: DataFrame, marginal: str, budget: float, temper: float) -> DataFrame:
    """(value, tokens, target) of a marginal: min(tokens, level * tokens ** temper), the level such that all sum to the budget.

    Values are ordered by the level at which they are full. The windows see a row per value."""
    sums = cells.groupBy(marginal).agg(F.sum("tokens").alias("t"))
    sums = sums.withColumn("w", F.when(F.col("t") > 0, F.pow(F.col("t").cast("double"), F.lit(temper))).otherwise(0.0))
    full_at = F.when(F.col("t") > 0, F.col("t") / F.col("w")).otherwise(0.0)
    up, down = Window.orderBy(full_at, marginal), Window.orderBy(full_at.desc(), F.desc(marginal))
    full = F.coalesce(F.sum("t").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_ = F.sum("w").over(down.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("t").over(Window.partitionBy()) * F.lit(float(budget))
    levels = sums.select(marginal, "t", "w", full_at.alias("full_at"), F.when(open_ > 0, (total - full) / open_).alias("level"))
    level = F.min(F.when(F.col("full_at") >= F.col("level"), F.struct("full_at", "level"))).over(Window.partitionBy())["level"]
    return levels.withColumn("chosen", level).select(
        marginal, F.col("t").alias("tokens"), F.least(F.col("t").cast("double"), F.coalesce(F.col("chosen") * F.col("w"), F.col("t").cast("double"))).alias("target")
    )


def raked_by(cells: DataFrame, marginal: str, others: Sequence[str], targets: DataFrame) -> DataFrame:
    """``cells`` with ``p`` scaled so that the expected tokens of every value meet its target as far as there are any."""
    mine = Window.partitionBy(marginal)
    down, up = mine.orderBy(F.desc("p"), *others), mine.orderBy("p", *(F.desc(o) for o in others))
    full = F.coalesce(F.sum("tokens").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(F.col("tokens") * F.col("p")).over(up.rowsBetween(Window.unboundedPreceding, 0))
    scaled = cells.join(targets.select(marginal, "target"), marginal).withColumns(
        {"at": F.row_number().over(down), "f": F.when(rest > 0, (F.col("target") - full) / rest).otherwise(1.0)}
    )
    fits = F.when(F.col("p") * F.col("f") <= 1.0, F.struct("at", "f"))
    f = F.min(fits).over(mine)["f"]
    return scaled.withColumn("f", f).withColumn("p", F.when(F.col("f").isNull(), 1.0).otherwise(F.least(F.lit(1.0), F.col("p") * F.col("f")))).select(*cells.columns)


def rake(cells: DataFrame, marginals: Sequence[str], budget: float, temper: float, rounds: int, tolerance: float = 0.0) -> DataFrame:
    """``cells`` (marginals, tokens) with a column ``p``; with a ``tolerance`` rounds end when all values are within it."""
    if not 0 < budget <= 1:
        raise ValueError("budget must be over 0 and at most 1")
    targets = {m: kept(targets_of(cells, m, budget, temper), f"target-{m}") for m in marginals}
    now = cells.withColumn("p", F.lit(float(budget)))
    for _ in range(rounds):
        for m in marginals:
            # Each step reads the last one several times, so it is written, or the plan would grow every time.
            now = kept(raked_by(now, m, [o for o in marginals if o != m], targets[m]), "raked")
        if tolerance > 0 and _apart(now, targets) <= tolerance:
            break
    return now


def _apart(now: DataFrame, targets: dict[str, DataFrame]) -> float:
    """The largest relative distance of expected tokens from their target."""
    far = 0.0
    for m, target in targets.items():
        have = now.groupBy(m).agg(F.sum(F.col("tokens") * F.col("p")).alias("have")).join(target, m).where("target > 0")
        far = max(far, have.agg(F.max(F.abs(F.col("have") / F.col("target") - 1))).first()[0] or 0.0)
    return far


def report(mixed: DataFrame, budget: float = 0.8, temper: float = 0.7) -> DataFrame:
    """(marginal, value, tokens, target, expected) of every source, language and topic of the rows of ``mix``."""
    by = ["source", "lang", "topic"]
    cells = kept(mixed.groupBy(*by, "p").agg(F.sum("n_tokens").alias("tokens")), "report")
    parts = []
    for m in by:
        expected = cells.groupBy(m).agg(F.sum(F.col("tokens") * F.col("p")).alias("expected"))
        part = targets_of(cells, m, budget, temper).join(expected, m)
        parts.append(part.select(F.lit(m).alias("marginal"), F.col(m).alias("value"), "tokens", "target", "expected"))
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def mix(
    documents: DataFrame, id_col: str = "doc_id", budget: float = 0.8, temper: float = 0.7, rounds: int = 8, keep: Sequence[str] = (),
    tolerance: float = 0.0, topic_col: str | None = None,
) -> DataFrame:
    """Every row's (id, source, lang, topic, n_tokens, p, sampled), and the columns to keep as a struct ``kept``.

    ``topic_col`` names a column of topics; without one a topic is told by marks in the text (``TOPICS``)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    measures = [
        F.col(id_col).alias("__id"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"),
        (topic(text) if topic_col is None else F.coalesce(F.col(topic_col).cast("string"), F.lit(""))).alias("topic"), tokens(text).alias("n_tokens"),
    ]
    rows = kept(documents.select(*measures), "mixed")
    by = ["source", "lang", "topic"]
    cells = kept(rows.groupBy(*by).agg(F.sum("n_tokens").alias("tokens")), "cells")
    raked = rake(cells, by, budget, temper, rounds, tolerance).select(*by, "p")
    if keep:
        # Texts are read again instead of being written beside the measures.
        rows = documents.select(*measures, F.struct(*keep).alias("kept"))
    out = rows.join(raked, by).withColumn("sampled", unit_hash(F.col("__id")) < F.col("p"))
    return out.select(F.col("__id").alias(id_col), *by, "n_tokens", F.round("p", 6).alias("p"), "sampled", *(["kept"] if keep else []))


def mix_sql(budget: float = 0.8, temper: float = 0.7, rounds: int = 8) -> str:
    """The same in SQL, with the rounds written out."""
    case = "CASE " + " ".join(
        "WHEN " + " OR ".join(f"contains(lower(body), '{m}')" for m in marks) + f" THEN '{name}'" for name, marks in TOPICS
    ) + " ELSE 'prose' END"
    ctes = [
        "body AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS body FROM documents)",
        f"rows AS (SELECT doc_id, source, lang, {case} AS topic, CAST(len(regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM body)",
        "cells AS (SELECT source, lang, topic, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM rows GROUP BY ALL)",
        f"c0 AS (SELECT *, {budget}::DOUBLE AS p FROM cells)",
    ]
    marginals = ("source", "lang", "topic")
    for m in marginals:
        ctes.append(
            f"s_{m} AS (SELECT {m}, sum(tokens) AS t, CASE WHEN sum(tokens) > 0 THEN pow(sum(tokens)::DOUBLE, {temper}::DOUBLE) ELSE 0 END AS w FROM cells GROUP BY {m})"
        )
        ctes.append(
            f"l_{m} AS (SELECT *, (sum(t) OVER () * {budget}::DOUBLE - coalesce(sum(t) OVER (ORDER BY full_at, {m} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))"
            f" / nullif(sum(w) OVER (ORDER BY full_at DESC, {m} DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS level"
            f" FROM (SELECT *, CASE WHEN t > 0 THEN t / w ELSE 0 END AS full_at FROM s_{m}))"
        )
        ctes.append(
            f"t_{m} AS (SELECT {m}, least(t::DOUBLE, coalesce((SELECT arg_min(level, full_at) FROM l_{m} WHERE full_at >= level) * w, t::DOUBLE)) AS target FROM l_{m})"
        )
    n = 0
    for _ in range(rounds):
        for m in marginals:
            a, b = (o for o in marginals if o != m)
            ctes.append(
                f"f{n} AS MATERIALIZED (SELECT c.*, row_number() OVER d AS pos, CASE WHEN sum(tokens * p) OVER u > 0 THEN"
                f" (target - coalesce(sum(tokens) OVER (PARTITION BY {m} ORDER BY p DESC, {a}, {b} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))"
                f" / sum(tokens * p) OVER u ELSE 1.0 END AS f FROM c{n} c JOIN t_{m} USING ({m})"
                f" WINDOW d AS (PARTITION BY {m} ORDER BY p DESC, {a}, {b}), u AS (PARTITION BY {m} ORDER BY p, {a} DESC, {b} DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"
            )
            ctes.append(
                f"c{n + 1} AS MATERIALIZED (SELECT f.source, f.lang, f.topic, f.tokens, CASE WHEN g.f IS NULL THEN 1.0 ELSE least(1.0::DOUBLE, p * g.f) END AS p"
                f" FROM f{n} f LEFT JOIN (SELECT {m}, arg_min(f, pos) AS f FROM f{n} WHERE p * f <= 1.0 GROUP BY {m}) g USING ({m}))"
            )
            n += 1
    unit = "('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE"
    return (
        f"WITH {', '.join(ctes)} SELECT doc_id, r.source, r.lang, r.topic, n_tokens, round(p, 6) AS p, {unit} < p AS sampled"
        f" FROM rows r JOIN c{n} c ON r.source = c.source AND r.lang = c.lang AND r.topic = c.topic"
    )
