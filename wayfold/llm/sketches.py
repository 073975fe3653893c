"""Sketches of fixed size: 2**SLOT_BITS bits, set where 64-bit hashes occur at least so often.

The counts cover all rows. Only one bit a slot goes to the driver and back to the tasks, so what is
broadcast has a fixed size (8 MB), whatever the input. A bit can be set without need but is never missing;
users only save work by it. ``frequent_slots`` counts the hits of a slot, of all its hashes together: cheap, but full when there
are as many hashes as slots. ``repeated_slots`` counts the hashes themselves, in tasks, and sets only slots of those that
do repeat: hashes that occur once do not fill it, however many there are.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SLOT_BITS = 26
RANGE_BITS = 18  # slots in one reduced range
RANGES = 1 << (SLOT_BITS - RANGE_BITS)
FLUSH = 1_000_000  # hashes gathered in a task before they are packed
COUNT_BITS = 12  # hashes are counted in so many ranges (a power of two), one at a time


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.uint32)


def packed(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Sorted slots as compressed differences, one row per range of slots."""
    if not found:
        return
    ordered = np.sort(np.concatenate(found))
    cuts = np.searchsorted(ordered, np.arange(RANGES + 1, dtype=np.uint64) << np.uint64(RANGE_BITS))
    rows = [
        (r, zlib.compress(np.diff(ordered[a:b], prepend=np.uint32(r << RANGE_BITS)).astype(np.uint32).tobytes(), 1))
        for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
        if b > a
    ]
    yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["range", "packed"])


def frequent_slots(
    texts: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], least: int
) -> np.ndarray:
    """One bit per slot: set where the hashes of all rows hit it ``least`` times or more."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for batch in batches:
            for some in hashes(batch):
                found.append(slots(some))
                held += len(some)
                if held >= FLUSH:
                    yield from packed(found)
                    found, held = [], 0
        yield from packed(found)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for r, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mine = counts.setdefault(r, np.zeros(1 << RANGE_BITS, np.uint32))
                at = np.cumsum(np.frombuffer(zlib.decompress(blob), np.uint32))
                np.add.at(mine, at, np.uint32(1)) if len(at) < 1000 else np.add(mine, np.bincount(at, minlength=1 << RANGE_BITS).astype(np.uint32), out=mine)
        for r, mine in counts.items():
            bits = np.packbits(mine >= least).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([zlib.compress(bits, 1)], pa.binary())], ["range", "bits"])

    rows = (
        texts.mapInArrow(gather, "range int, packed binary")
        .repartition(min(RANGES, 64), F.col("range"))
        .mapInArrow(count, "range int, bits binary")
    )
    out = np.zeros(1 << (SLOT_BITS - 3), np.uint8)
    width = 1 << (RANGE_BITS - 3)
    for r, bits in rows.collect():  # at most RANGES rows of fixed size
        out[r * width : (r + 1) * width] = np.frombuffer(zlib.decompress(bits), np.uint8)
    return out


def repeated_slots(texts: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> np.ndarray:
    """One bit per slot: set where a hash falls that occurs twice or more among all rows."""

    def rows_of(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not found:
            return
        once, times = np.unique(np.concatenate(found), return_counts=True)
        ordered = np.repeat(once, np.minimum(times, 2))  # a third copy says no more
        cuts = np.searchsorted(ordered >> np.uint64(64 - COUNT_BITS), np.arange((1 << COUNT_BITS) + 1))
        rows = [(r, ordered[a:b].tobytes()) for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["range", "hashes"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for batch in batches:
            for some in hashes(batch):
                found.append(some)
                held += len(some)
                if held >= FLUSH:
                    yield from rows_of(found)
                    found, held = [], 0
        yield from rows_of(found)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found, set_ = None, [], []

        def repeated() -> np.ndarray:
            ordered = np.sort(np.frombuffer(b"".join(found), np.uint64))
            return np.unique(slots(ordered[1:][ordered[1:] == ordered[:-1]]))

        for batch in batches:
            for r, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r != now and found:
                    set_.append(repeated())
                    found = []
                now = r
                found.append(data)
        if found:
            set_.append(repeated())
        if set_ and len(at := np.concatenate(set_)):
            at.sort()
            for r in np.unique(at >> RANGE_BITS):
                bits = np.zeros(1 << RANGE_BITS, np.uint8)
                bits[at[at >> RANGE_BITS == r] & ((1 << RANGE_BITS) - 1)] = 1
                yield pa.RecordBatch.from_arrays([pa.array([int(r)], pa.int32()), pa.array([zlib.compress(np.packbits(bits).tobytes(), 1)], pa.binary())], ["range", "bits"])

    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (
        texts.mapInArrow(gather, "range int, hashes binary")
        # the ranges that share a range of slots go to one task, which counts them one after the other
        .repartition(parts, F.shiftright("range", COUNT_BITS - (SLOT_BITS - RANGE_BITS))).sortWithinPartitions("range")
        .mapInArrow(count, "range int, bits binary")
    )
    out = np.zeros(1 << (SLOT_BITS - 3), np.uint8)
    width = 1 << (RANGE_BITS - 3)
    for r, bits in rows.collect():  # a row of fixed size per range of slots
        out[r * width : (r + 1) * width] |= np.frombuffer(zlib.decompress(bits), np.uint8)
    return out


def hit(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = slots(hashes)
    return (bits[at >> np.uint32(3)] >> (7 - (at & np.uint32(7))).astype(np.uint8)) & 1 == 1
