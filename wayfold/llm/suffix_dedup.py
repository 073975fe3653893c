"""Suffix-array dedup: removes every byte that a repeated string of ``span`` bytes covers.

A sparse suffix array: only suffixes that start at anchors are sorted. The anchor of a window of
``span`` bytes is its gram of GRAM bytes with the least hash (leftmost on ties). It depends on the
window's bytes alone, so equal windows have their anchors at the same place, and no repeat is missed.

1. Anchors are counted over all documents, and a sketch of those that repeat goes to all tasks; windows whose anchor
   occurs once are done.
2. For the rest, neighbouring windows with one anchor form a run: the bytes that they cover (the
   context) and its digest. Equal runs of one task are sent once, with a row per text that holds
   them: a text of one repeated line has one row with many places.
3. Sampled splitters deal the runs in ranges of the anchored suffixes' leading bytes. Suffixes with
   equal leading bytes are never parted, so there is nothing left to compare across a boundary. In a
   bucket the anchored suffixes are sorted by multikey quicksort, eight bytes a key. Suffixes that
   agree on the whole gram are neighbours; a run that occurs twice is repeated as a whole, and of
   the others all windows of the neighbours are compared. Where over CROWD bytes of runs have the
   same leading bytes (a passage at whose edges very many texts differ), their windows are dealt by
   their own hashes instead, so that no task gets them all.
4. Repeated ranges go back to their texts and are cut out.

Matches never cross documents; strings are judged on the input. Defined cases: a null or short text
keeps all its bytes (none, if null); a text that occurs twice and has ``span`` bytes is removed
whole, in all its copies; rows with one id are separate documents; extra columns are passed by.
Windows and runs are compared by 64- and 128-bit hashes of their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wayfold.llm.common import Rolling, kept, mix, slices, small_batches, text_column
from wayfold.llm.sketches import hit, repeated_slots

GRAM = 64
PLACE = np.uint64((1 << 24) - 1)  # low bits of a packed minimum: the place; above: the hash
PIECE = 1 << 18  # windows handled at a time, and bytes whose words are coded at a time
CHUNK = 16 << 20  # bytes of contexts compared at a time
CROWD = 4 << 20  # bytes of contexts with the same leading bytes that are compared in one task
SALTS = 16
CODE = 8  # letters of a word's code
_rolling = Rolling()


def anchored(data: np.ndarray, offsets: np.ndarray, span: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(place in data, window starts, their anchors, hashes of all grams), piece by piece, of the
    windows that lie inside one text; starts and anchors count from that place."""
    wide = span - GRAM + 1
    for at in range(0, max(0, len(data) - span + 1), PIECE):
        part = data[at : at + PIECE + span - 1]
        count = len(part) - span + 1
        start = np.arange(len(part) - GRAM + 1)
        grams = _rolling.ranges(_rolling.sums(part), start, start + GRAM)
        low = (grams & ~PLACE) | start.astype(np.uint64)
        low = np.concatenate([low, np.full(-len(low) % wide, ~np.uint64(0))]).reshape(-1, wide)
        ahead = np.minimum.accumulate(low, axis=1).ravel()
        behind = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:count], ahead[wide - 1 : wide - 1 + count])
        window = np.arange(count)
        ends = offsets[np.searchsorted(offsets, window + at, side="right")] - at
        inside = window + span <= ends
        yield at, window[inside], (least[inside] & PLACE).astype(np.int64), grams


def bytes_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(the bytes, the texts' offsets in them) of slice after slice of the texts."""
    for _, _, data, offsets in slices(text_column(batch)):
        yield data, offsets


def _anchor_hashes(batch: pa.RecordBatch, span: int, strings: Callable = bytes_of) -> Iterator[np.ndarray]:
    for data, offsets in strings(batch):
        for _, _, anchors, grams in anchored(data, np.append(offsets, len(data) + span), span):
            if len(anchors):
                # A run never ends and begins again, so each change is a new anchor. Anchors are least
                # hashes, so they are mixed again before they are dealt to slots.
                yield mix(grams[anchors[np.flatnonzero(np.diff(anchors, prepend=-1))]])


def runs(texts: DataFrame, span: int, bits, strings: Callable = bytes_of) -> DataFrame:
    """A row per text and run of windows whose anchor may be repeated, with all its places. Of one text, a task
    reports two copies at most: more copies say no more than that it is repeated."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copies: dict[bytes, int] = {}
        sent: set[bytes] = set()
        rows: list[tuple] = []
        held = 0

        def out() -> pa.RecordBatch:
            names = ["key", "at", "digest", "lead0", "lead1", "anchor", "context"]
            types = [pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for batch in batches:
            for data, offsets in strings(batch):
                whole = data.tobytes()
                keys: dict[int, bytes | None] = {}
                for at, windows, anchors, grams in anchored(data, np.append(offsets, len(data) + span), span):
                    often = hit(bits.value, mix(grams[anchors]))
                    windows, anchors = windows[often], anchors[often]
                    if not len(windows):
                        continue
                    breaks = np.flatnonzero((np.diff(windows) != 1) | (np.diff(anchors) != 0)) + 1
                    first = np.concatenate([[0], breaks])
                    last = np.concatenate([breaks, [len(windows)]]) - 1
                    doc = np.searchsorted(offsets, windows[first] + at, side="right") - 1
                    own: dict[tuple[int, bytes], list[int]] = {}
                    for d, p, q, a in zip(doc.tolist(), windows[first].tolist(), windows[last].tolist(), anchors[first].tolist(), strict=True):
                        if d not in keys:
                            if len(copies) >= 500_000:
                                copies.clear()
                            key = hashlib.sha256(whole[offsets[d] : offsets[d + 1]]).digest()
                            copies[key] = copies.get(key, 0) + 1
                            keys[d] = key if copies[key] <= 2 else None
                        if keys[d] is None:
                            continue
                        context = whole[at + p : at + q + span]
                        digest = hashlib.blake2b(context, digest_size=16).digest()
                        if (places := own.get((d, digest))) is not None:
                            places.append(at + p - int(offsets[d]))
                            held += 8
                            continue
                        own[d, digest] = places = [at + p - int(offsets[d])]
                        lead = np.frombuffer(context, ">i8", 2, a - p)
                        new = digest not in sent
                        if new:
                            if len(sent) >= 500_000:
                                sent.clear()
                            sent.add(digest)
                            held += len(context)
                        held += 80
                        rows.append((keys[d], places, digest, int(lead[0]), int(lead[1]), a - p, context if new else None))
                    if held >= 4_000_000:
                        yield out()
                        rows.clear()
                        held = 0
        if rows:
            yield out()

    return texts.mapInArrow(task, "key binary, at array<bigint>, digest binary, lead0 bigint, lead1 bigint, anchor int, context binary")


def multikey_groups(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Group number of each suffix by its first ``length`` bytes: sorted by one eight-byte key after
    the other, each time only where the keys so far are equal."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    order = np.arange(len(starts))
    group = np.zeros(len(starts), np.int64)
    open_ = np.arange(len(starts))
    for depth in range(0, length, 8):
        at = starts[order[open_]] + depth
        key = np.zeros(len(at), np.uint64)
        for k in range(8):
            key = (key << np.uint64(8)) | padded[at + k].astype(np.uint64)
        inner = np.lexsort((key, group[open_]))
        order[open_], key = order[open_][inner], key[inner]
        group[open_] = group[open_][inner]
        fresh = np.zeros(len(starts) + 1, np.int64)
        if len(open_) > 1:
            same_place = np.diff(open_) == 1
            split = (group[open_][1:] == group[open_][:-1]) & (np.diff(key.astype(np.int64)) != 0) & same_place
            fresh[open_[1:][split]] = 1
        edge = np.concatenate([[True], np.diff(group) != 0]) | (fresh[:-1] == 1)
        group = np.cumsum(edge) - 1
        sizes = np.bincount(group)
        open_ = np.flatnonzero(sizes[group] > 1)
        if not len(open_):
            break
    out = np.empty(len(starts), np.int64)
    out[order] = group
    return out


def window_hashes(contexts: list[bytes], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of windows of each context, and of all windows in a row: places in their contexts, hashes)."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    base = np.cumsum(sizes) - sizes
    counts = sizes - span + 1
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = place + np.repeat(base, counts)
    sums = _rolling.sums(np.frombuffer(b"".join(contexts), np.uint8))
    return counts, place, _rolling.ranges(sums, starts, starts + span)


def _repeats(rows: list[tuple[bytes, int, int, bytes]], span: int) -> Iterator[tuple[bytes, int, int]]:
    """(digest, first window, last window) repeated, of distinct runs (digest, times, anchor, context)."""
    for digest, times, _, context in rows:
        if times > 1:
            yield digest, 0, len(context) - span
    if len(rows) < 2:
        return
    sizes = np.array([len(r[3]) for r in rows])
    base = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
    group = multikey_groups(data, base + np.array([r[2] for r in rows]), GRAM)
    near = np.flatnonzero(np.bincount(group)[group] > 1).tolist()
    if not near:
        return
    counts, _, hashes = window_hashes([rows[k][3] for k in near], span)
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    same = np.concatenate([[False], ordered[1:] == ordered[:-1], [False]])
    twice = np.zeros(len(hashes), bool)
    twice[order] = same[:-1] | same[1:]
    for k, at, count in zip(near, (np.cumsum(counts) - counts).tolist(), counts.tolist(), strict=True):
        digest, times, _, _ = rows[k]
        if times > 1:
            continue
        mine = np.flatnonzero(np.diff(np.concatenate([[False], twice[at : at + count], [False]]).astype(np.int8)))
        for first, end in mine.reshape(-1, 2).tolist():
            yield digest, first, end - 1


def crowded_ranges(rows: DataFrame, span: int) -> DataFrame:
    """(digest, first, last) as below, of runs whose leading bytes very many runs have: every window is a row
    and dealt by its own hash, counted map side. Equal windows have equal leading bytes, so none of them is elsewhere."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            counts, place, hashes = window_hashes(batch.column(3).to_pylist(), span)
            own = batch.select([0, 1, 2]).take(pa.array(np.repeat(np.arange(len(counts)), counts)))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(place, pa.int32()), pa.array(hashes.view(np.int64))], ["digest", "lead0", "times", "at", "hash"])

    distinct = rows.groupBy("digest", "lead0").agg(F.sum("times").alias("times"), F.max("context").alias("context"))
    windows = kept(distinct.mapInArrow(task, "digest binary, lead0 bigint, times bigint, at int, hash bigint"), "windows")
    # A window inside the passage is in all of the runs: its rows are dealt to SALTS groups.
    twice = windows.groupBy("hash", "lead0").agg(F.sum("times").alias("n")).where("n > 1")
    twice = twice.select("hash", "lead0", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("salt"))
    met = windows.withColumn("salt", F.pmod(F.xxhash64("digest"), F.lit(SALTS))).join(twice, ["hash", "lead0", "salt"], "left_semi")
    # At most span windows a run; unbroken places differ from their ranks by the same number.
    ranked = met.withColumn("run", F.col("at") - F.row_number().over(Window.partitionBy("digest").orderBy("at")))
    return ranked.groupBy("digest", "run").agg(F.min("at").alias("first"), F.max("at").alias("last")).select("digest", "first", "last")


def repeated_ranges(found: DataFrame, span: int, crowd: int) -> DataFrame:
    """(digest, first, last): the windows of each distinct run that occur anywhere else."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = []
        lead = None
        held = 0

        def out() -> pa.RecordBatch:
            got = list(_repeats([tuple(r) for r in rows], span))
            return pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], t) for i, t in enumerate((pa.binary(), pa.int32(), pa.int32()))], ["digest", "first", "last"])

        for batch in batches:
            for digest, lead0, lead1, anchor, context, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (lead0, lead1) != lead and held >= CHUNK:
                    yield out()
                    rows, held = [], 0
                lead = (lead0, lead1)
                if rows and rows[-1][0] == digest:
                    rows[-1][1] += times
                    if rows[-1][3] is None and context is not None:
                        rows[-1][3] = context
                        held += len(context)
                else:
                    rows.append([digest, times, anchor, context])
                    held += len(context or b"")
        if rows:
            yield out()

    # Rows without a context are counted map side; each task's first one carries it.
    bare = found.where("context IS NULL").groupBy("digest", "lead0", "lead1", "anchor").agg(F.sum(F.size("at")).alias("times"))
    full = found.where("context IS NOT NULL").withColumn("times", F.size("at").cast("bigint"))
    names = ["digest", "lead0", "lead1", "anchor", "context", "times"]
    rows = full.select(names).unionByName(bare.withColumn("context", F.lit(None).cast("binary")).select(names))
    lead = ["lead0", "lead1"]
    sizes = found.where("context IS NOT NULL").groupBy(*lead).agg(F.sum(F.octet_length("context")).alias("bytes"))
    crowds = kept(sizes.where(F.col("bytes") > crowd).select(*lead), "crowds")
    some = not crowds.isEmpty()
    if some:
        crowded, rows = rows.join(crowds, lead, "left_semi"), rows.join(crowds, lead, "left_anti").select(names)
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, "lead0", "lead1").sortWithinPartitions("lead0", "lead1", "digest")
    ranges = dealt.mapInArrow(task, "digest binary, first int, last int")
    return ranges.unionByName(crowded_ranges(crowded, span)) if some else ranges


def repeated_spans(texts: DataFrame, span: int, crowd: int = CROWD, strings: Callable = bytes_of) -> DataFrame:
    """(key, spans): by the SHA-256 of each string that has repeats, its runs {at, first, last}; a repeated range goes from
    ``at + first`` to ``at + last + span``. The strings are made of the texts in the tasks that read them: a step of its
    own would be a second Python worker beside each."""
    bits = texts.sparkSession.sparkContext.broadcast(repeated_slots(texts, lambda b: _anchor_hashes(b, span, strings)))
    found = kept(runs(texts, span, bits, strings), "runs")
    ranges = kept(repeated_ranges(found, span, crowd), "ranges")
    return (
        found.select("key", "at", "digest").join(ranges, "digest")
        .groupBy("key").agg(F.collect_set(F.struct("at", "first", "last")).alias("spans"))
    )


def without_repeats(documents: DataFrame, id_col: str = "doc_id", span: int = 400, keep: tuple[str, ...] = (), crowd: int = CROWD) -> DataFrame:
    """(id, the columns ``keep``, kept binary, n_bytes, n_removed, n_spans) of every row; see the module's text."""
    if span < GRAM + 16:
        raise ValueError(f"span must be {GRAM + 16} at least")
    small_batches(documents.sparkSession)
    spans = repeated_spans(documents.select(F.col("text").cast("string").alias("text")), span, crowd)
    rows = documents.select(
        F.col(id_col).alias("__id"), *(F.col(c).alias(f"__{c}") for c in keep), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("key", F.unhex(F.sha2("text", 256)))
    joined = rows.join(spans, "key", "left").drop("key")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bytes_, sizes, removed, parts = [], [], [], []
            for text, marks in zip(batch.column(len(keep) + 1).to_pylist(), batch.column(len(keep) + 2).to_pylist(), strict=True):
                data = text.encode()
                at, rest, n = 0, [], 0
                for s, e in sorted((a + m["first"], a + m["last"] + span) for m in marks or () for a in m["at"]):
                    if s > at or not n:
                        rest.append(data[at:s])
                        n += 1
                    at = max(at, e)
                rest.append(data[at:])
                left = b"".join(rest)
                bytes_.append(left)
                sizes.append(len(data))
                removed.append(len(data) - len(left))
                parts.append(n)
            made = [pa.array(bytes_, pa.binary()), *(pa.array(x, pa.int64()) for x in (sizes, removed, parts))]
            names = [*batch.schema.names[: len(keep) + 1], "kept", "n_bytes", "n_removed", "n_spans"]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep) + 1], *made], names)

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(keep) + 1])
    done = joined.mapInArrow(cut, f"{own}, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint")
    return done.select(F.col("__id").alias(id_col), *(F.col(f"__{c}").alias(c) for c in keep), "kept", "n_bytes", "n_removed", "n_spans")


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words `[^\\x20\\x09-\\x0D]+`; a word ends with its text."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    inside = np.concatenate([~space, [False]])
    first = inside[:-1] & ~np.concatenate([[False], inside[:-2]]) if len(data) else inside[:0]
    cuts = offsets[1:-1][offsets[1:-1] < len(data)]
    first[cuts] |= inside[cuts]
    last = inside[:-1] & ~inside[1:]
    last[cuts[cuts > 0] - 1] |= inside[cuts[cuts > 0] - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def codes_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every word as CODE letters of its hash, without blanks, and where each text's codes end."""
    starts, ends = words_of(data, offsets)
    letters = np.empty((len(starts), CODE), np.uint8)
    cuts = np.unique(np.searchsorted(starts, np.arange(0, len(data) + PIECE, PIECE)))
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        at = starts[i]
        hashes = mix(_rolling.ranges(_rolling.sums(data[at : ends[j - 1]]), starts[i:j] - at, ends[i:j] - at))
        for k in range(CODE):
            letters[i:j, k] = 48 + ((hashes >> np.uint64(6 * k)) & np.uint64(63)).astype(np.uint8)
    return letters.ravel(), CODE * np.searchsorted(starts, offsets[1:], side="left")


def codes(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """As ``bytes_of``, of the texts' codes, all of one width: a string of n words is one of n * CODE bytes."""
    for data, offsets in bytes_of(batch):
        letters, ends = codes_of(data, offsets)
        yield letters, np.concatenate([[0], ends])


def without_passages(documents: DataFrame, words: int = 50, id_col: str = "doc_id", keep: tuple[str, ...] = (), crowd: int = CROWD) -> DataFrame:
    """(id, the columns ``keep``, text, n_removed, n_passages) of every row: passages of ``words`` words or more that occur anywhere
    else are cut, whatever their bytes and the white space between the words; n_removed counts words.

    Words are coded by hashes of one width, so the same suffix array finds them as strings of ``words * CODE`` bytes. All
    occurrences go: which one is first would hang on the order of the documents, and what many documents share is seldom of
    one of them. A passage goes with the white space behind it. A null text is an empty one, and short texts stay as they are."""
    span = words * CODE
    if span < GRAM + 16:
        raise ValueError(f"a passage must have {-(-(GRAM + 16) // CODE)} words at least")
    small_batches(documents.sparkSession)
    spans = repeated_spans(documents.select(F.col("text").cast("string").alias("text")), span, crowd, codes)
    rows = documents.select(
        F.col(id_col).alias("__id"), *(F.col(c).alias(f"__{c}") for c in keep), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    width = len(keep) + 1
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:width])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[bytes] = []
            for letters, ends in codes(batch):
                whole, cuts = letters.tobytes(), ends.tolist()
                keys += [hashlib.sha256(whole[a:b]).digest() for a, b in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, "key"])

    joined = rows.mapInArrow(keyed, f"{own}, text string, key binary").join(spans, "key", "left").drop("key")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed, passages = [], [], []
            for text, marks in zip(batch.column(width).to_pylist(), batch.column(width + 1).to_pylist(), strict=True):
                found: list[list[int]] = []
                for s, e in sorted((-(-(a + m["first"]) // CODE), (a + m["last"] + span) // CODE) for m in marks or () for a in m["at"]):
                    if e - s >= words and found and s <= found[-1][1]:
                        found[-1][1] = max(found[-1][1], e)
                    elif e - s >= words:
                        found.append([s, e])
                if found:
                    data = text.encode()
                    starts, _ = words_of(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
                    edges = [*starts.tolist(), len(data)]
                    at, rest = 0, []
                    for s, e in found:
                        rest.append(data[at : edges[s]])
                        at = edges[e]
                    text = b"".join([*rest, data[at:]]).decode()
                texts.append(text)
                removed.append(sum(e - s for s, e in found))
                passages.append(len(found))
            made = [pa.array(texts, pa.string()), pa.array(removed, pa.int64()), pa.array(passages, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *made], [*batch.schema.names[:width], "text", "n_removed", "n_passages"])

    done = joined.mapInArrow(cut, f"{own}, text string, n_removed bigint, n_passages bigint")
    return done.select(F.col("__id").alias(id_col), *(F.col(f"__{c}").alias(c) for c in keep), "text", "n_removed", "n_passages")
