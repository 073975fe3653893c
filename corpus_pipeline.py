"""The corpus pipeline: five stages, each over all rows that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns
of ``documents``; texts that the suffix-array stage shortens have their ``n_chars`` counted again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayfold.llm import cases, classifier, common, mixing, ngram_jaccard, sentencepiece_codec, suffix_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects (score under 0.3)."""
    model = classifier.fit(docs, cases.table(spark, sf_dir, "labels"))
    return classifier.score(docs, model, COLUMNS).where("score >= 0.3").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row, the one with the smallest id (null last) and then hash of the row, of each group of near copies.

    Rows that share an id but not a group are all kept. Equal rows count as one, but for rows without an id
    and without shingles, which are no copies of each other.
    """
    parts = (F.coalesce(F.concat(F.lit("="), F.col(c).cast("string"), F.lit("\0")), F.lit("-\0")) for c in COLUMNS)
    no_id, filled = F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType))
    rows = docs.select(*COLUMNS, F.struct(no_id.alias("no_id"), filled.alias("id"), F.md5(F.concat(*parts)).alias("hash")).alias("row"))
    groups = ngram_jaccard.jaccard_components(rows, "row")
    heads = groups.where("row = component_id").select("row", "n_shingles").distinct()
    one = F.when(F.col("row.no_id") & (F.col("n_shingles") == 0), F.monotonically_increasing_id())
    return rows.join(heads, "row").withColumn("one", one).dropDuplicates(["row", "one"]).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 words and more that occur elsewhere out of every text, all their occurrences: which one is the
    first would hang on the order of the documents. A text that is one such passage stays as an empty one. Columns
    other than those of ``documents`` are dropped, here as in every stage."""
    cut = suffix_dedup.without_passages(docs, keep=("lang", "source"))
    return cut.select("doc_id", "text", "lang", "source", F.length("text").cast("bigint").alias("n_chars"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples rows, each by its own cell's probability, raked to source, language and topic targets.

    A row without an id is drawn by the hash of its text, as all would share the hash of no id.
    """
    drawn = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    sampled = mixing.mix(docs.select(*COLUMNS, drawn.alias("drawn_by")), "drawn_by", keep=COLUMNS)
    return sampled.where("sampled").select("kept.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each text."""
    return sentencepiece_codec.encode_documents(docs, cases.MODEL, keep=("lang", "source"))


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("mixture", mixture), ("encoded", encoded),
]

#: Learning, cutting at bytes and tokenizing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = cases.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.kept(stage(spark, docs, sf_dir), name)
    return docs
