"""Operators on documents against brute force, and their defined cases."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfold.llm import cases, classifier, mixing, ngram_jaccard, quality_rules, sentencepiece_codec, suffix_dedup
from wayfold.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component string, key string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "ab", "cd"]) if rng.random() < 0.3 else f"w{rng.randrange(10**6)}" for _ in range(n))


def corpus():
    """Copies, chains of near copies, a shared passage, repeated lines, odd and empty texts, repeated rows, nulls."""
    rng = random.Random(5)
    base = words_of(rng, 120).split()
    texts = [" ".join(base)] * 6
    for step in range(30):
        near = list(base)
        near[rng.randrange(120)] = f"x{step}"
        texts.append(" ".join(near))
        base = near if step % 3 == 0 else base
    passage = words_of(rng, 90)
    texts += [f"{words_of(rng, rng.randrange(5, 80))} {passage}" for _ in range(40)]
    texts += [words_of(rng, rng.randrange(1, 9)) for _ in range(20)]
    texts += ["", None, " \n\t", "One two", "one  TWO", "é " * 300, "ab\n" * 400, "De " * 500, "x" * 5000, words_of(rng, 4000)]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", None]), 0, "clash", "k") for i, t in enumerate(texts)]
    return rows + [rows[3], (None, "no id here at all", "en", "a", 0, "c", "k")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text):
    w = WORD.findall((text or "").translate({k: k + 32 for k in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_jaccard_components(docs):
    rows = corpus()
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r[0])
    want = Counter((r[0], len(sets[i]), min((x for x in groups[find(i)] if x is not None), default=None)) for i, r in enumerate(rows))
    assert Counter(tuple(r) for r in ngram_jaccard.jaccard_components(docs).collect()) == want


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


def cut_out(texts, span):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[k : k + span] for b in data for k in range(len(b) - span + 1))
    out = []
    for b in data:
        mark = bytearray(len(b))
        for k in range(len(b) - span + 1):
            if seen[b[k : k + span]] > 1:
                mark[k : k + span] = b"\1" * span
        rest = bytes(x for x, m in zip(b, mark, strict=True) if not m)
        out.append((len(b), len(b) - len(rest), len([x for x in bytes(mark).split(b"\0") if x]), hashlib.sha256(rest).hexdigest()))
    return out


@pytest.mark.parametrize(("span", "crowd"), [(400, suffix_dedup.CROWD), (90, suffix_dedup.CROWD), (400, 3000), (90, 200), (90, 0)])
def test_repeats_are_cut(docs, span, crowd):
    """With a small ``crowd``, runs of the shared passage are compared window by window."""
    rows = corpus()
    want = Counter((r[0], *c) for r, c in zip(rows, cut_out([r[1] for r in rows], span), strict=True))
    got = suffix_dedup.without_repeats(docs, span=span, crowd=crowd).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got) == want


def cut_passages(texts, n):
    """(the text if it stays whole, words cut, runs of them, words left): cut is what a string of n words covers that
    also starts anywhere else."""
    split = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[k : k + n]) for w in split for k in range(len(w) - n + 1))
    out = []
    for t, w in zip(texts, split, strict=True):
        gone = {k + j for k in range(len(w) - n + 1) if seen[tuple(w[k : k + n])] > 1 for j in range(n)}
        runs = sum(k - 1 not in gone for k in gone)
        out.append((None if gone else t or "", len(gone), runs, [x for k, x in enumerate(w) if k not in gone]))
    return out


@pytest.mark.parametrize(("n", "crowd"), [(50, suffix_dedup.CROWD), (12, suffix_dedup.CROWD), (12, 200)])
def test_passages_are_cut_by_words(docs, n, crowd):
    """Also where white space differs, words are short (50 words are 99 bytes) or long, and passages touch."""
    rng = random.Random(8)
    rows = corpus()
    short = " ".join(rng.choice("abcdefghij") for _ in range(60))
    long = " ".join("é" * 40 + str(rng.randrange(10**6)) for _ in range(55))
    spaced = words_of(rng, 70)
    extra = [f"{words_of(rng, 9)} {short} tail {k}" for k in range(3)] + [f"head {k} {long}" for k in range(2)] + [f"{long}\n{short}", spaced, spaced.replace(" ", " \n")]
    rows += [(5000 + k, t, "en", "a", 0, "", "") for k, t in enumerate(extra)]
    frame = docs.unionAll(docs.sparkSession.createDataFrame(rows[-len(extra) :], DOCS))
    got = suffix_dedup.without_passages(frame, n, keep=("lang",), crowd=crowd).collect()
    want = cut_passages([r[1] for r in rows], n)
    have = Counter((r.doc_id, r.lang, r.n_removed, r.n_passages, tuple(WORD.findall(r.text))) for r in got)
    assert have == Counter((r[0], r[2], gone, runs, tuple(left)) for r, (_, gone, runs, left) in zip(rows, want, strict=True))
    whole = Counter((r[0], text) for r, (text, *_) in zip(rows, want, strict=True) if text is not None)
    assert not whole - Counter((r.doc_id, r.text) for r in got)


def test_a_passage_goes_with_the_blank_behind_it(spark):
    passage = " ".join(f"w{k}" for k in range(50))
    rows = [(1, f"Before. {passage}\n After é."), (2, f"{passage}"), (3, f"x {passage} "), (4, passage[:-4])]
    got = suffix_dedup.without_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.text, r.n_removed, r.n_passages) for r in got} == {1: ("Before. After é.", 50, 1), 2: ("", 50, 1), 3: ("x ", 50, 1), 4: (passage[:-4], 0, 0)}
    assert suffix_dedup.without_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_step_of_passages_has_one_python_worker(docs, monkeypatch):
    """Of the steps over all texts none is a second worker that makes the codes beside the one that uses them."""
    plans = {}
    kept, counted = suffix_dedup.kept, suffix_dedup.repeated_slots

    def keep(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return kept(df, name)

    def count(texts, hashes):
        plans["texts"] = texts._jdf.queryExecution().executedPlan().toString()
        return counted(texts, hashes)

    monkeypatch.setattr(suffix_dedup, "kept", keep)
    monkeypatch.setattr(suffix_dedup, "repeated_slots", count)
    suffix_dedup.without_passages(docs)
    assert "MapInArrow" not in plans["texts"]
    assert plans["runs"].count("MapInArrow") == 1


def test_long_texts_are_handled_piece_by_piece(monkeypatch):
    """One text of 6 MB of words of two bytes: 24 MB of codes. Anchors and codes do not depend on the pieces."""
    rng = np.random.default_rng(8)
    text = np.full(6_000_000, 32, np.uint8)
    text[::2] = rng.integers(97, 123, 3_000_000)
    offsets = np.array([0, len(text)])
    tracemalloc.start()
    letters, ends = suffix_dedup.codes_of(text, offsets)
    for _ in suffix_dedup.anchored(letters, np.append([0, ends[0]], len(letters) + 400), 400):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 250e6

    text = rng.choice(np.frombuffer(b"abc \n", np.uint8), 30_000)
    text[4_000:7_500] = 100  # a word that is longer than a piece
    offsets = np.array([0, 0, 2_500, 2_500, 2_501, 9_000, 26_000, 30_000])

    def found():
        letters, ends = suffix_dedup.codes_of(text, offsets)
        places = np.append(np.concatenate([[0], ends]), len(letters) + 90)
        windows = [(w + at, a + at) for at, w, a, _ in suffix_dedup.anchored(letters, places, 90)]
        return letters.tobytes(), ends.tolist(), *(np.concatenate(x).tolist() for x in zip(*windows, strict=True))

    want = found()
    monkeypatch.setattr(suffix_dedup, "PIECE", 1_000)
    assert found() == want


def test_a_full_sketch_still_tells_repeats(spark, monkeypatch):
    """Ten hashes a slot: few that occur once pass, all that repeat do."""
    from wayfold.llm import sketches

    monkeypatch.setattr(sketches, "SLOT_BITS", 12)
    monkeypatch.setattr(sketches, "RANGE_BITS", 8)
    monkeypatch.setattr(sketches, "RANGES", 16)
    monkeypatch.setattr(sketches, "FLUSH", 3000)
    rng = np.random.default_rng(4)
    once = rng.integers(0, 2**64, 41_000, np.uint64)
    twice = rng.integers(0, 2**64, 150, np.uint64)
    every = np.concatenate([once, twice, twice, np.repeat(twice[:3], 500)])
    rng.shuffle(every)
    frame = spark.createDataFrame([(part.tobytes(),) for part in np.array_split(every, 90)], "text binary").repartition(5)
    bits = sketches.repeated_slots(frame, lambda b: (np.frombuffer(x, np.uint64) for x in b.column(0).to_pylist()))
    assert sketches.hit(bits, twice).all()
    assert sketches.hit(bits, once).mean() < 0.1
    assert not sketches.repeated_slots(frame.limit(0), lambda b: iter(())).any()


@pytest.mark.parametrize("slot_bits", [10, 26])
def test_repeats_do_not_depend_on_the_sketch(docs, monkeypatch, slot_bits):
    from wayfold.llm import sketches

    monkeypatch.setattr(sketches, "SLOT_BITS", slot_bits)
    monkeypatch.setattr(sketches, "RANGE_BITS", 8 if slot_bits == 10 else 18)
    rows = corpus()
    want = Counter((r[0], *c) for r, c in zip(rows, cut_out([r[1] for r in rows], 90), strict=True))
    got = suffix_dedup.without_repeats(docs, span=90).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got) == want


def test_multikey_groups():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 2, 3000).astype(np.uint8)
    starts = np.arange(0, 2900)
    got = suffix_dedup.multikey_groups(data, starts, 24)
    names = [data[s : s + 24].tobytes() for s in starts]
    order = {n: i for i, n in enumerate(sorted(set(names)))}
    assert got.tolist() == [order[n] for n in names]


def quality_counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_quality_counts_and_base(docs):
    got = quality_rules.judge(docs).collect()
    assert len(got) == len(corpus())
    have = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert have == Counter((r[0], *quality_counts(r[1])) for r in corpus())
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_quality_thresholds_follow_the_source(spark):
    """A rate that is usual in one source and odd in another is dropped only in the other."""
    rng = random.Random(1)
    text = lambda marks: " ".join(f"w{rng.randrange(10**6)}" + ("%" if i < marks else "") for i in range(100))
    rows = [(i, text(40 + i % 5), "en", "symbols", 0, "", "") for i in range(300)]
    rows += [(1000 + i, text(0), "en", "plain", 0, "", "") for i in range(300)] + [(5000, text(42), "en", "plain", 0, "", "")]
    kept = {r.doc_id: r.kept for r in quality_rules.judge(spark.createDataFrame(rows, DOCS)).collect()}
    assert [i for i, k in kept.items() if not k] == [5000]


@pytest.mark.parametrize("size", [100, 150, 250, 10_000])
def test_a_mostly_junk_source_is_judged_alike_at_every_size(spark, size):
    """Its own upper quartile is junk; the other sources of its language are not."""
    rng = random.Random(2)
    pool = [f"w{rng.randrange(10**6)}" for _ in range(5000)]
    text = lambda marks: " ".join(w + "%%%" * marks for w in rng.sample(pool, 60))
    rows = [(i, text(i % 10 < 6), "en", "hot", 0, "", "") for i in range(size)]
    rows += [(100_000 + i, text(0), "en", f"s{i % 3}", 0, "", "") for i in range(360)]
    got = quality_rules.judge(spark.createDataFrame(rows, DOCS).repartition(4)).select("doc_id", "kept").collect()
    assert len(got) == len(rows)
    assert all(r.kept == (r.doc_id >= 100_000 or r.doc_id % 10 >= 6) for r in got)


def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=cases.MODEL)


def test_pieces_equal_the_library(docs):
    lib = library()
    got = sentencepiece_codec.encode_documents(docs, cases.MODEL)
    want = Counter((r[0], None if r[1] is None else tuple(lib.encode(r[1]))) for r in corpus())
    rows = got.collect()
    assert Counter((r.doc_id, None if r.ids is None else tuple(r.ids)) for r in rows) == want
    assert all(r.round_trip for r in rows if r.ids is not None)
    back = sentencepiece_codec.decode_documents(got.select("doc_id", "ids"), cases.MODEL).collect()
    assert Counter(map(tuple, back)) == Counter((r[0], r[1]) for r in corpus())


def test_pieces_of_odd_texts():
    lib, rng = library(), random.Random(2)
    texts = ["  a  b ", "▁▁a▁", "\0a\0", "<s> <0x0A>\r\t", "漢字\U0001f600é́", "ab" * 900, " " * 40]
    texts += ["".join(rng.choice("ab the▁.\n漢é01") for _ in range(rng.randrange(1, 400))) for _ in range(100)]
    v = sentencepiece_codec.Vocabulary(sentencepiece_codec.read_model(cases.MODEL))
    flat, counts = sentencepiece_codec.Encoder(v).encode(texts)
    ends = np.cumsum(counts)
    for text, end, count in zip(texts, ends, counts, strict=True):
        ids = flat[end - count : end].tolist()
        assert ids == lib.encode(text)
        assert v.decode(ids) == lib.decode(ids)


def test_best_path_of_a_unigram_model():
    v = sentencepiece_codec.Vocabulary(sentencepiece_codec.read_model(cases.MODEL))
    v.kind = sentencepiece_codec.UNIGRAM
    score = {v.pieces[i]: v.scores[i] for i in v.ids}

    def best(word):
        sums = [0.0]
        for end in range(1, len(word) + 1):
            sums.append(max(sums[s] + score[word[s:end]] for s in range(end) if word[s:end] in score))
        return sums[-1]

    for word in ("▁the", "▁international", "▁xqzé"):
        ids, _ = v.encode_words([word])
        assert "".join(v.pieces[i] for i in ids) == word
        assert sum(v.scores[i] for i in ids) == best(word)


def test_mixing_meets_its_targets(spark):
    rng = random.Random(4)
    rows = [(i, words_of(rng, rng.randrange(5, 60)), rng.choice(["en", "en", "de"]), rng.choice("aaab"), 0, "", "") for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS), budget=0.4, temper=0.5, rounds=12).toPandas()
    total = got.n_tokens.sum()
    for m in ("source", "lang"):
        tokens = got.groupby(m).n_tokens.sum()
        target = tokens**0.5 / (tokens**0.5).sum() * total * 0.4
        have = (got.n_tokens * got.p).groupby(got[m]).sum()
        assert np.allclose(have, target, rtol=0.02)
        drawn = got[got.sampled].groupby(m).n_tokens.sum()
        assert np.allclose(drawn, target, rtol=0.15)


def test_mixing_meets_all_targets_of_the_table(spark):
    """Also those of small values, which are kept whole; the rest of their share goes to the others."""
    from oracle import sf_dir

    docs = cases.table(spark, sf_dir("0.1"), "documents")
    mixed = mixing.mix(docs).cache()
    rows = mixing.report(mixed).collect()
    assert {r.marginal for r in rows} == {"source", "lang", "topic"}
    assert all(abs(r.expected - r.target) <= 0.02 * r.target for r in rows)
    for m in ("source", "lang", "topic"):
        own = [r for r in rows if r.marginal == m]
        total = sum(r.tokens for r in own)
        assert abs(sum(r.target for r in own) - 0.8 * total) <= 1e-6 * total and all(r.target <= r.tokens + 1e-6 for r in own)
    assert any(r.target == r.tokens for r in rows)
    drawn = mixed.agg(F.sum(F.when(F.col("sampled"), F.col("n_tokens"))) / F.sum("n_tokens")).first()[0]
    assert abs(drawn - 0.8) < 0.03


def test_mixing_stops_by_tolerance_and_takes_a_topic_column(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, words_of(rng, rng.randrange(5, 60)), rng.choice(["en", "en", "de"]), rng.choice("aaab"), 0, "", rng.choice("xyyz")) for i in range(800)]
    frame, steps = spark.createDataFrame(rows, DOCS), []
    counted = mixing.raked_by
    monkeypatch.setattr(mixing, "raked_by", lambda *a: steps.append(1) or counted(*a))
    mixed = mixing.mix(frame, budget=0.5, tolerance=0.01, rounds=30, topic_col="key")
    assert 3 <= len(steps) < 60 and {r.topic for r in mixed.select("topic").distinct().collect()} == {"x", "y", "z"}
    assert all(abs(r.expected - r.target) <= 0.011 * r.target for r in mixing.report(mixed, budget=0.5).collect())


def test_classifier(spark, docs):
    rng = random.Random(6)
    rows = [(i, words_of(rng, 60) if i % 3 else "!!! ".join(words_of(rng, 60).upper().split()), "en", "a", 0, "", "") for i in range(900)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(900)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame([*rows, (9001, "", "en", "a", 0, "", ""), (9002, None, "en", "a", 0, "", ""), (None, "a b", "en", "a", 0, "", "")], DOCS)
    got = classifier.classify(frame, labels).collect()
    assert len(got) == 903
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert held and all((r.predicted == 1) == (r.doc_id % 3 > 0) for r in held)
    by = {r.doc_id: r for r in got}
    assert by[9001].score == by[9002].score and 0 <= by[9001].score <= 1 and by[None].held_out
    assert all(r.score == 0.5 for r in classifier.classify(docs, labels.where("false")).collect())


def test_empty_tables(spark):
    none = empty(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for frame in (
        ngram_jaccard.jaccard_components(none), suffix_dedup.without_repeats(none), quality_rules.judge(none), mixing.mix(none),
        sentencepiece_codec.encode_documents(none, cases.MODEL), classifier.classify(none, labels),
    ):
        assert frame.count() == 0


def test_nulls_do_not_break_mixing(docs):
    got = mixing.mix(docs).collect()
    assert len(got) == len(corpus())
    assert all(0 <= r.p <= 1 for r in got)


def test_runs_do_not_depend_on_slices(spark, docs, monkeypatch):
    from wayfold.llm import common

    want = Counter(map(tuple, ngram_jaccard.jaccard_components(docs).collect()))
    monkeypatch.setattr(common, "SLICE_BYTES", 700)
    assert Counter(map(tuple, ngram_jaccard.jaccard_components(docs.repartition(5)).collect())) == want


