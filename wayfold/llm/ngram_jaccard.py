"""N-gram Jaccard join by vertical partitioning.

All word shingles stand in one global order: rare ones first, frequent ones last, each by hash. That
order is cut into fragments. A document's set is cut the same way, the overlap of a pair is counted
in each fragment on its own, and the counts are summed per pair.

Which pairs are counted: documents with the same set are one class from the start. Two classes can
only link if they share a shingle among their first ones (prefix filter), so rows (shingle, class)
of prefixes are sorted by shingle. In each such bucket all members are first paired with its first
member only; the links found that way are merged to components. Then members of one bucket that are
still in different components are compared, in blocks, so no bucket is one group and no group of
copies is expanded to all its pairs. Sizes, places in the order and bit signatures give upper bounds
that rule out most pairs; none of them can rule out a link.

Defined cases: a null or wordless text has no shingles and is linked with nothing; a text of fewer
words than a shingle has its whole word sequence as one; repeated rows and equal texts are one class;
a null id is left out of minima (a component without any id has a null one). Extra columns are
ignored. Hashes are 64 bits wide: two different shingles are taken for one with a chance of about
n * n / 2**65 for n distinct ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wayfold.llm.common import Rolling, kept, mix, slices, small_batches, text_column
from wayfold.llm.components import components
from wayfold.llm.sketches import frequent_slots, hit

FREQUENT = 32  # a shingle slot hit so often, beyond twice the mean load, counts as frequent
CUTS = 4  # fragments among rare shingles, and as many among frequent ones
SIGNATURE = 2048  # bits
MULTIPLIER = np.uint64(0xC2B2AE3D27D4EB4F)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rolling = Rolling()


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in the bytes, and the first word of each text (and the total)."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, its sorted distinct shingle hashes), for every row of the batch."""
    for first, end, data, offsets in slices(text_column(batch)):
        if not len(data):
            yield from ((row, np.empty(0, np.uint64)) for row in range(first, end))
            continue
        starts, ends, cut = word_spans(data, offsets)
        words = _rolling.ranges(_rolling.sums(_LOWER[data]), starts, ends) + (ends - starts).astype(np.uint64)
        grams = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for k in range(width):
            grams = grams * MULTIPLIER + words[k : k + len(grams)]
        grams = mix(grams)
        for row, a, b in zip(range(first, end), cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            if b - a >= width:
                yield row, np.unique(grams[a : b - width + 1])
            elif b > a:
                one = np.array([b - a], np.uint64)
                for k in range(a, b):
                    one = mix(one * MULTIPLIER + words[k : k + 1])
                yield row, one
            else:
                yield row, np.empty(0, np.uint64)


def set_id(grams: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def signature(grams: np.ndarray) -> bytes:
    """The parities of how many shingles fall on each of SIGNATURE bits."""
    odd = np.bincount((grams >> np.uint64(5)).astype(np.int64) & (SIGNATURE - 1), minlength=SIGNATURE) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def least_overlap(n: int, percent: int) -> int:
    """The smallest overlap that any link of a set of n needs."""
    return -(-percent * n // 100)


def _distinct_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Non-empty sets, mostly once each per task; later steps drop what is repeated."""
    seen: set[int] = set()
    for batch in batches:
        for _, grams in shingle_sets(batch, width):
            if len(grams) and (key := set_id(grams)) not in seen:
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(key)
                yield key, grams


def profiles(documents: DataFrame, id_col: str, width: int) -> DataFrame:
    """(id, n_shingles, set_id, signature) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, signs = [], [], []
            for _, grams in shingle_sets(batch, width):
                sizes.append(len(grams))
                keys.append(set_id(grams) if len(grams) else None)
                signs.append(signature(grams) if len(grams) else None)
            made = [pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(signs, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["id", "n", "set_id", "signature"])

    rows = documents.select(F.col(id_col).alias("id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n bigint, set_id bigint, signature binary")


def prefixes(texts: DataFrame, width: int, percent: int, bits) -> DataFrame:
    """(shingle, set_id, n, pos) for the first shingles of each set in the global order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, int, int]] = []
        total = 0

        def out() -> pa.RecordBatch:
            sizes = [len(p) for p, _, _ in held]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([p for p, _, _ in held]).view(np.int64)),
                    pa.array(np.repeat(np.array([k for _, k, _ in held], np.int64), sizes)),
                    pa.array(np.repeat(np.array([n for _, _, n in held], np.int32), sizes)),
                    pa.array(np.concatenate([np.arange(s, dtype=np.int32) for s in sizes])),
                ],
                ["shingle", "set_id", "n", "pos"],
            )

        for key, grams in _distinct_sets(batches, width):
            n = len(grams)
            want = n - least_overlap(n, percent) + 1
            often = hit(bits.value, grams)
            first = grams[~often][:want]
            if len(first) < want:
                first = np.concatenate([first, grams[often][: want - len(first)]])
            held.append((first, key, n))
            total += len(first)
            if total >= 200_000:
                yield out()
                held, total = [], 0
        if held:
            yield out()

    return texts.mapInArrow(run, "shingle bigint, set_id bigint, n int, pos int")


def stars(rows: DataFrame) -> DataFrame:
    """Each bucket's members paired with its first: sorted by shingle, read as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: np.ndarray | None = None  # the last row seen and the first row of its bucket
        pivot: np.ndarray | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
            shingle, key = now[0], now[1]
            if last is None:
                last, pivot = np.array([[~shingle[0]], [0], [0], [0]]), np.zeros((4, 1), np.int64)
            before = np.concatenate([last[0], shingle[:-1]])
            opens = shingle != before
            again = ~opens & (key == np.concatenate([last[1], key[:-1]]))
            table = np.concatenate([pivot, now], axis=1)
            first = np.maximum.accumulate(np.where(opens, np.arange(1, now.shape[1] + 1), 0))
            member = ~opens & ~again
            p, m = table[:, first[member]], now[:, member]
            last, pivot = now[:, -1:], table[:, first[-1:]]
            if m.shape[1]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (m[0], p[1], p[2], p[3], m[1], m[2], m[3])],
                    ["shingle", "p_id", "p_n", "p_pos", "set_id", "n", "pos"],
                )

    dealt = rows.repartition("shingle").sortWithinPartitions("shingle", "pos", "n", "set_id")
    return dealt.mapInArrow(run, "shingle bigint, p_id bigint, p_n bigint, p_pos bigint, set_id bigint, n bigint, pos bigint")


def segments(texts: DataFrame, width: int, bits, pairs: DataFrame) -> DataFrame:
    """The sets of the pairs cut into fragments of the global order: (set_id, fragment, its hashes).

    Their ids go to the tasks as a sketch of fixed size, which saves most of the others; the join after it is exact."""
    ids = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    wanted = texts.sparkSession.sparkContext.broadcast(frequent_slots(ids, lambda b: iter([mix(b.column(0).to_numpy().view(np.uint64))]), 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fragments, blobs, held = [], [], [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(fragments, pa.int32()), pa.array(blobs, pa.binary())], ["set_id", "fragment", "grams"])

        for key, grams in _distinct_sets(batches, width):
            if not hit(wanted.value, mix(np.array([key], np.int64).view(np.uint64)))[0]:
                continue
            place = (grams >> np.uint64(62)).astype(np.int32) + CUTS * hit(bits.value, grams)
            for f in range(2 * CUTS):
                part = grams[place == f]
                if len(part):
                    keys.append(key)
                    fragments.append(f)
                    blobs.append(part.tobytes())
                    held += part.nbytes
            if held >= 4_000_000:
                yield out()
                keys, fragments, blobs, held = [], [], [], 0
        if keys:
            yield out()

    found = texts.mapInArrow(run, "set_id bigint, fragment int, grams binary")
    return kept(found.join(ids, "set_id", "left_semi").dropDuplicates(["set_id", "fragment"]), "segments")


def _may_link(xor: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """From the signatures' differing bits: a pair that differs in more shingles than a link allows is out."""
    apart = np.bitwise_count(xor.view(np.uint64)).sum(axis=-1, dtype=np.int64)
    return (100 + percent) * (sizes - apart) >= 2 * percent * sizes


def signed(pairs: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, na, nb) whose signatures allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SIGNATURE // 8) for i in (4, 5))
            sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            yield batch.filter(pa.array(_may_link(x ^ y, sizes, percent))).select([0, 1, 2, 3])

    both = (
        pairs.join(signs.select(F.col("set_id").alias("a"), F.col("signature").alias("sa")), "a")
        .join(signs.select(F.col("set_id").alias("b"), F.col("signature").alias("sb")), "b")
        .select("a", "b", "na", "nb", "sa", "sb")
    )
    return both.mapInArrow(run, "a bigint, b bigint, na bigint, nb bigint")


def linked(pairs: DataFrame, cut: DataFrame, percent: int) -> DataFrame:
    """The pairs whose overlaps, counted per fragment and summed, reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common = []
            for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common.append(len(x) + len(y) - len(np.union1d(x, y)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(common, pa.int64())], ["a", "b", "na", "nb", "common"])

    parts = (
        pairs.withColumn("fragment", F.explode(F.array(*(F.lit(f) for f in range(2 * CUTS)))))
        .join(cut.select(F.col("set_id").alias("a"), "fragment", F.col("grams").alias("ga")), ["a", "fragment"])
        .join(cut.select(F.col("set_id").alias("b"), "fragment", F.col("grams").alias("gb")), ["b", "fragment"])
        .select("a", "b", "na", "nb", "ga", "gb")
        .mapInArrow(run, "a bigint, b bigint, na bigint, nb bigint, common bigint")
    )
    total = parts.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
    return total.where(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def _allowed(na, nb, pa_, pb, percent: int):
    """Size and place: what can still be common from a shared shingle on must reach the overlap a link needs."""
    left = F.least(na - pa_, nb - pb)
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & ((100 + percent) * left >= percent * (na + nb))


def across(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of one bucket in different components that sizes and places allow. The join tests them as it
    reads the bucket and can split a large one; buckets of one component are left out."""
    mixed = members.groupBy("shingle").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 < c1")
    rows = members.join(mixed.select("shingle"), "shingle", "left_semi")
    x = rows.select("shingle", F.col("set_id").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("component").alias("ca"))
    y = rows.select("shingle", F.col("set_id").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("component").alias("cb"))
    where = (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _allowed(F.col("na"), F.col("nb"), F.col("pa"), F.col("pb"), percent)
    return x.join(y.withColumnRenamed("shingle", "same"), (F.col("shingle") == F.col("same")) & where).select("a", "b", "na", "nb").distinct()


def _links(pairs: DataFrame, signs: DataFrame, texts: DataFrame, width: int, bits, percent: int) -> DataFrame:
    """Those of the candidate pairs that link."""
    left = kept(signed(pairs, signs, percent), "pairs")
    return kept(linked(left, segments(texts, width, bits, left), percent), "links") if not left.isEmpty() else left.select("a", "b")


def jaccard_components(documents: DataFrame, id_col: str = "doc_id", width: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``documents``; see the module's text.

    Two rows link when 100 * intersection >= percent * union of their shingle sets.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be between 50 and 100")
    small_batches(documents.sparkSession)
    spark = documents.sparkSession
    sc = spark.sparkContext
    texts = documents.select(F.col("text").cast("string").alias("text"))
    rows = kept(profiles(documents, id_col, width), "profiles")
    total = rows.agg(F.sum("n")).first()[0] or 0
    least = FREQUENT + 2 * (total >> 26)
    bits = sc.broadcast(frequent_slots(texts, lambda b: (g for _, g in shingle_sets(b, width)), least))
    buckets = kept(stars(prefixes(texts, width, percent, bits)), "buckets")
    ids = buckets.select(F.col("p_id").alias("set_id")).union(buckets.select("set_id")).distinct()
    signs = rows.select("set_id", "signature").join(ids, "set_id", "left_semi").dropDuplicates(["set_id"])
    signs = kept(signs, "signatures")

    first = buckets.where(100 * F.least("p_n", "n") >= percent * F.greatest("p_n", "n"))
    less = F.col("p_id") < F.col("set_id")
    pairs = first.select(
        F.least("p_id", "set_id").alias("a"), F.greatest("p_id", "set_id").alias("b"),
        F.when(less, F.col("p_n")).otherwise(F.col("n")).alias("na"), F.when(less, F.col("n")).otherwise(F.col("p_n")).alias("nb"),
    ).distinct()
    links = _links(pairs, signs, texts, width, bits, percent)
    labels = kept(components(links), "labels")

    member = ["shingle", "set_id", "n", "pos"]
    heads = buckets.select("shingle", F.col("p_id").alias("set_id"), F.col("p_n").alias("n"), F.col("p_pos").alias("pos")).distinct()
    members = buckets.select(member).union(heads).join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    members = members.withColumn("component", F.coalesce("component", "set_id"))
    more = _links(across(members, percent), signs, texts, width, bits, percent)
    labels = kept(components(links.union(more)), "labels") if not more.isEmpty() else labels

    tied = rows.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("component", "set_id"))
    tied = tied.select("id", "n", "root")
    least_id = tied.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("least"))
    return tied.join(least_id, "root", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"),
    )
