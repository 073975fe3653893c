"""The queries beside their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from oracle import compare, connect, sf_dir

import corpus_pipeline
from wayfold.llm import cases, common, mixing

SMALL = sf_dir("0.001")


@pytest.mark.parametrize("name", sorted(cases.SQL))
def test_query_equals_sql(spark, name):
    assert compare(cases.QUERIES[name](spark, SMALL), connect(SMALL), cases.SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(cases.QUERIES) - set(cases.SQL)))
def test_query_returns_every_row(spark, name):
    source = "pages" if "html" in name else "documents"
    assert cases.QUERIES[name](spark, SMALL).count() == cases.table(spark, SMALL, source).count()


def test_classifier_holds_out(spark):
    got = cases.op10_quality_classifier(spark, sf_dir("0.01")).join(cases.table(spark, sf_dir("0.01"), "labels"), "doc_id").where("held_out").collect()
    assert len(got) > 50
    assert sum(r.predicted == r.quality for r in got) >= 0.97 * len(got)


def test_pipeline(spark):
    """Each stage works on what the one before kept; rows only go where its decision says so."""
    docs = cases.table(spark, SMALL, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = common.kept(stage(spark, docs, SMALL), name)
        seen[name] = docs
        if name != "encoded":
            assert docs.columns == before.columns
    assert seen["quality"].join(cases.table(spark, SMALL, "labels").where("quality = 1"), "doc_id").count() >= 0.95 * cases.table(spark, SMALL, "labels").where("quality = 1").count()
    left = cases.ngram_jaccard.jaccard_components(seen["near_duplicates"])
    assert left.where("doc_id <> component_id").count() == 0
    assert seen["repeated_passages"].count() == seen["near_duplicates"].count()
    assert seen["encoded"].count() == seen["mixture"].count() > 0
    assert seen["encoded"].where("round_trip").count() >= 0.95 * seen["encoded"].count()


ROWS = "doc_id long, text string, lang string, source string, n_chars long"


def test_pipeline_decides_by_row(spark):
    """Rows without an id, and rows that share one, go only where a stage's decision says so."""
    rng = random.Random(4)
    text = lambda n=80: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    same, copy = text(), text()
    rows = [(None, text()), (None, text()), (7, text()), (7, text()), (None, same), (3, same), (9, same), (None, copy), (None, copy), (None, " "), (None, " ")]
    rows = [(i, t, "en" if n % 2 else None, "a", len(t)) for n, (i, t) in enumerate(rows)] + [(12, None, "en", "a", None)] * 2
    docs = spark.createDataFrame(rows, ROWS).repartition(3)
    got = Counter(r[:2] for r in map(tuple, corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()))
    assert got == Counter(r[:2] for r in rows[:4] + [rows[5], rows[7], *rows[9:12]])

    texts = [text(20) + ("?" if n % 3 else "") for n in range(400)]
    docs = spark.createDataFrame([(None if n % 2 else n // 8, t, "en", "a", len(t)) for n, t in enumerate(texts)], ROWS)
    cells = {r.topic: r.p for r in mixing.mix(docs).select("topic", "p").distinct().collect()}
    unit = lambda key: int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2**52
    want = [t for n, t in enumerate(texts) if unit(hashlib.md5(t.encode()).hexdigest() if n % 2 else str(n // 8)) < cells["dialogue" if "?" in t else "prose"]]
    got = corpus_pipeline.mixture(spark, docs, SMALL)
    assert got.columns == docs.columns
    assert sorted(r.text for r in got.collect()) == sorted(want)


def test_results_only_hold_the_shared_root(spark):
    assert common.fresh(spark, "x").startswith(common.shared_root(spark))
