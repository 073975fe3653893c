"""Quality rules with adaptive thresholds, in DataFrame functions only.

Every document gets counts over its whole text. Documents that pass the fixed base rules feed
mergeable quantile sketches (KLL) of four rates, one sketch per language and source. A group's fences
are its upper quartile plus REACH times its interquartile range and a slack (and, for the word length,
the same below), so they follow each source. At every size a group of n documents counts n / (n + PRIOR) in its
quartiles and its language's typical quartiles the rest; a language is blended with all groups in the same way. Typical
quartiles are the middle of the sources' own, in which a source has at most VOTES votes however large it is. No fence
is further than DISTANCE slacks from that of the language, so a source that is mostly junk does not open
its own. Documents beyond a fence of their group are not kept. Junk that fills over a quarter of most sources of a
language is usual there, and is not told apart.

The sketches are aggregated with partial results before the shuffle and have a bounded size, so a hot source
costs no more than any other. The join brings a few numbers per group to the documents' counts.

Defined cases: a null text has no words and fails the base; a null language or source is the group
''; rows with one id are judged one by one; an empty table gives no rows; extra columns are ignored. 3-word windows
are compared by 64-bit hashes of their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wayfold.llm.common import kept

#: Documents that the typical quartiles count as, beside those of a group.
PRIOR = 20
VOTES = 20
DISTANCE = 2.0
REACH = 3.0
SKETCH_K = 400
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Rates with the slack that is added to the fence.
RATES = {"word_length": 0.5, "symbol_rate": 0.1, "line_rate": 0.3, "repeat_rate": 0.2}
QUARTILES = [f"{r}_{q}" for r in RATES for q in ("q1", "q3")]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def count_of(text: Column, characters: str) -> Column:
    """How many characters of the text are among these."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("bigint")


def counts(documents: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, lang, source) and the counts of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(
        F.col(id_col).alias("__id"), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
        text.alias("body"), words(text).alias("w"),
    )
    n = F.size("w")
    w = F.col("w")
    window = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    none = F.array().cast("array<bigint>")
    rows = rows.withColumn("windows", F.when(n < 3, none).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))), window)))
    ordered = F.sort_array("windows")
    rows = rows.withColumn("ordered", ordered)
    again = F.exists(F.sequence(F.lit(1), F.greatest(F.size("ordered") - 1, F.lit(1))), lambda i: F.coalesce(F.get("ordered", i) == F.get("ordered", i - 1), F.lit(False)))
    rows = rows.withColumn("again", again)
    # Only texts that repeat a window sort the windows with their places.
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("placed", F.when(F.col("again"), placed))
    same = lambda x, k: F.coalesce(F.get("placed", k)["h"] == x["h"], F.lit(False))
    twice = F.filter("placed", lambda x, k: same(x, k + 1) | ((k > 0) & same(x, F.greatest(k - 1, F.lit(0)))))
    rows = rows.withColumn("places", F.sort_array(F.transform(twice, lambda x: x["i"])))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        "places", start,
        lambda a, i: F.struct((a["n"] + i + 3 - F.greatest(a["end"], i)).alias("n"), (i + 3).alias("end")),
        lambda a: a["n"],
    )
    lines = F.filter(F.split("body", "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    rows = rows.withColumn("lines", lines)
    return rows.select(
        "__id", "lang", "source",
        n.cast("bigint").alias("n_words"),
        F.length(F.translate("body", BLANKS, "")).cast("bigint").alias("word_chars"),
        count_of(F.col("body"), SYMBOLS).alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )


def rates() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "word_length": F.col("word_chars") / n,
        "symbol_rate": F.col("n_symbols") / n,
        # A few lines and words more below, so that one repeated line of a short text is no high rate.
        "line_rate": F.col("n_dup_lines") / (F.col("n_lines") + 5).cast("double"),
        "repeat_rate": F.col("n_repeat_words") / (n + 50),
    }


def _typical(votes: DataFrame, *by: str) -> DataFrame:
    """(by, m documents, the middle of the votes for each quartile)."""
    found = votes.groupBy(*by).agg(F.sum(F.when(F.col("vote") == 1, F.col("n"))).alias("m"), *(F.kll_sketch_agg_double(q, F.lit(SKETCH_K)).alias(q) for q in QUARTILES))
    # Two quantiles, so that of two sources neither is the middle.
    middle = lambda q: (F.kll_sketch_get_quantile_double(q, F.lit(0.45)) + F.kll_sketch_get_quantile_double(q, F.lit(0.55))) / 2
    return found.select(*by, "m", *(F.when(F.col("m").isNotNull(), middle(F.col(q))).alias(q) for q in QUARTILES))


def _blend(n: Column, own: Column, typical: Column) -> Column:
    weight = n / (n + F.lit(float(PRIOR)))
    return F.when(own.isNull(), typical).otherwise(weight * own + (1 - weight) * typical)


def fences(rows: DataFrame) -> DataFrame:
    """(lang, source, and per rate its low and high fence) from the documents that pass the base."""
    good = rows.where(~F.col("base_failed")).withColumns(rates())
    group = good.groupBy("lang", "source").agg(F.count("*").alias("n"), *(F.kll_sketch_agg_double(r, F.lit(SKETCH_K)).alias(r) for r in RATES))
    quartiles = (F.kll_sketch_get_quantile_double(r, F.lit(at)).alias(f"{r}_{q}") for r in RATES for q, at in (("q1", 0.25), ("q3", 0.75)))
    group = kept(group.select("lang", "source", "n", *quartiles), "quartiles")
    share = F.round(VOTES * F.col("n") / (F.col("n") + PRIOR)).cast("int")
    votes = group.withColumn("vote", F.explode(F.sequence(F.lit(1), F.greatest(share, F.lit(1)))))
    lang = _typical(votes, "lang").select("lang", F.struct("m", *QUARTILES).alias("typical"))
    every = _typical(votes).select(F.struct(*QUARTILES).alias("every"))
    # All groups of the rows, also those in which no document passes the base.
    asked = rows.groupBy("lang", "source").agg(F.count("*").alias("asked"))
    joined = asked.join(group, ["lang", "source"], "left").join(lang, "lang", "left")
    one = every.withColumn("k", F.lit(1))
    out = joined.withColumn("k", F.lit(1)).join(one, "k", "left")
    out = out.withColumns({f"{q}_lang": _blend(F.col("typical.m"), F.col(f"typical.{q}"), F.col(f"every.{q}")) for q in QUARTILES})
    out = out.withColumns({q: _blend(F.col("n"), F.col(q), F.col(f"{q}_lang")) for q in QUARTILES})
    for r, slack in RATES.items():
        for side, quartile, sign in (("low", "q1", -1.0), ("high", "q3", 1.0)):
            own, typical = (F.col(f"{r}_{quartile}{of}") + sign * (REACH * (F.col(f"{r}_q3{of}") - F.col(f"{r}_q1{of}")) + slack) for of in ("", "_lang"))
            out = out.withColumn(f"{r}_{side}", F.greatest(F.least(own, typical + DISTANCE * slack), typical - DISTANCE * slack))
    return out.select("lang", "source", *(f"{r}_{side}" for r in RATES for side in ("low", "high")))


def judge(documents: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Every document's counts, ``base_failed`` and ``kept``."""
    rows = counts(documents, id_col)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = kept(rows.withColumn("base_failed", failed), "counts")
    limits = kept(fences(rows), "fences")
    met = rows.join(limits, ["lang", "source"], "left")
    fine = F.lit(True)
    for r, value in rates().items():
        above = F.coalesce(value > F.col(f"{r}_high"), F.lit(False))
        below = F.coalesce(value < F.col(f"{r}_low"), F.lit(False)) if r == "word_length" else F.lit(False)
        fine = fine & ~above & ~below
    return met.select(
        F.col("__id").alias(id_col), "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & fine).alias("kept"),
    )
