"""Quality classifier from supervised subword embeddings.

A text's features are its words, pairs of neighbouring words and the 3- to 5-byte n-grams inside
words (with their borders), hashed to BUCKETS rows of a table of vectors. A document is the average of
its features' vectors, a softmax over two outputs gives the score. Vectors and outputs are learned by numpy
stochastic gradient descent on a bounded sample of labelled rows: the SAMPLE ones of least hash, that
is a parameter. Their features are counted by the tasks; only these counts, of bounded size, meet in
the one task that learns. As average and output are linear, the learned model comes down to one
number per bucket and a bias, which is what the tasks score with.

A pair of equal words has one feature, whatever the word. Letters are taken in lower case as well as
as they are: an n-gram of capitals is not one of small letters.

Defined cases: null and empty texts have no features and get the bias's score; rows without a text,
label or id teach nothing; rows with a null id count as held out; repeated labels of an id are
several examples; without any example every score is 0.5; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wayfold.llm.common import Rolling, mix, slices, small_batches, text_column

BUCKETS_BITS = 18
DIMENSIONS = 8
GRAMS = (3, 4, 5)
SAMPLE = 4000
EPOCHS = 6
RATE = 2.0
FOLDS = 5
SAME = np.uint64(0x5AE1F00D5AE1F00D)  # the feature of two equal neighbours

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLAIN = np.where(_SPACE, 32, np.arange(256)).astype(np.uint8)
_rolling = Rolling()


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(first byte, bucket) of the features of all texts in the bytes, kind by kind; the features of a
    text lie between its offsets."""
    n = len(data)
    if not n:
        return
    space = _SPACE[data]
    sums = _rolling.sums(_PLAIN[data])
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    inside = ~space
    starts = np.flatnonzero(inside & (np.concatenate([[True], space[:-1]]) | edge[:-1]))
    ends = np.flatnonzero(inside & (np.concatenate([space[1:], [True]]) | edge[1:])) + 1
    shift = np.uint64(64 - BUCKETS_BITS)
    words = _rolling.ranges(sums, starts, ends)
    yield starts, (mix(words + np.uint64(1)) >> shift).astype(np.int32)
    if len(words) > 1:
        near = ~(np.add.reduceat(edge[: n + 1].astype(np.int32), starts + 1)[:-1] > 0)
        pair = np.where(words[1:] == words[:-1], SAME, mix(words[:-1] * np.uint64(31) + words[1:]))
        yield starts[:-1][near], (mix(pair[near] + np.uint64(2)) >> shift).astype(np.int32)
    spaces = np.concatenate([[0], np.cumsum(space, dtype=np.int32)])
    edges = np.cumsum(edge, dtype=np.int32)
    for size in GRAMS:
        at = np.arange(max(0, n - size + 1))
        # nothing but the ends may be white space, and no text's border lies inside
        ok = (spaces[at + size - 1] == spaces[at + 1]) & (edges[at + size - 1] == edges[at])
        at = at[ok]
        grams = _rolling.ranges(sums, at, at + size)
        yield at, (mix(grams + np.uint64(2 + size)) >> shift).astype(np.int32)


def bags(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(distinct buckets, their shares) of each row's text."""
    for _, _, data, offsets in slices(text_column(batch)):
        parts = list(features(data, offsets))
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            mine = [f[np.searchsorted(p, a) : np.searchsorted(p, b)] for p, f in parts]
            ids, times = np.unique(np.concatenate(mine), return_counts=True) if mine else (np.empty(0, np.int32), np.empty(0))
            yield ids.astype(np.int32), (times / max(1, times.sum())).astype(np.float32)


def learn(examples: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> tuple[np.ndarray, float]:
    """(a number per bucket, bias): the two-class softmax of averaged vectors, learned by SGD."""
    random = np.random.default_rng(seed)
    table = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BUCKETS_BITS, DIMENSIONS)).astype(np.float32)
    output, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    steps = max(1, EPOCHS * len(examples))
    done = 0
    for _ in range(EPOCHS if examples else 0):
        for k in random.permutation(len(examples)):
            ids, shares, label = examples[k]
            rate = RATE * (1 - done / steps)
            done += 1
            hidden = shares @ table[ids]
            z = output @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1  # the loss by the outputs
            back = output.T @ p
            output -= rate * np.outer(p, hidden)
            bias -= rate * 0.01 * p
            # Shares are small; a step relative to the largest one moves the vectors at the pace of the output.
            table[ids] -= rate * np.outer(shares / max(float(shares.max(initial=0)), 1e-9), back) * 0.1
    return (table @ (output[1] - output[0])).astype(np.float32), float(bias[1] - bias[0])


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % FOLDS == 0, F.lit(True))


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """The model learned from at most ``sample`` labelled rows that are not held out."""
    chosen = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label")).where(
        F.col("__label").isin(0, 1) & ~held_out(F.col("__id"))
    )
    chosen = chosen.orderBy(F.md5(F.col("__id").cast("string")), "__label").limit(sample)
    texts = documents.select(F.col(id_col).alias("__id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    # At most ``sample`` rows of two numbers are broadcast.
    rows = texts.join(F.broadcast(chosen), "__id").select("text", "__label", F.md5(F.col("__id").cast("string")).alias("at"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(bags(batch))
            lists = [pa.array([f[i].tobytes() for f in found], pa.binary()) for i in range(2)]
            yield pa.RecordBatch.from_arrays([*lists, batch.column(1), batch.column(2)], ["ids", "shares", "label", "at"])

    def train(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["at", "label", "ids"])
        examples = [
            (np.frombuffer(i, np.int32), np.frombuffer(s, np.float32), int(y))
            for i, s, y in zip(group["ids"], group["shares"], group["label"], strict=True)
        ]
        weights, bias = learn([e for e in examples if len(e[0])])
        return pd.DataFrame({"weights": [weights.tobytes()], "bias": [bias]})

    # Repeated documents of a chosen id can exceed the bound, so it holds for the examples as well.
    counted = rows.mapInArrow(count, "ids binary, shares binary, label int, at string").orderBy("at", "label", F.xxhash64("ids")).limit(sample)
    model = counted.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(train, "weights binary, bias double").first()
    if model is None:
        return np.zeros(1 << BUCKETS_BITS, np.float32), 0.0
    return np.frombuffer(model["weights"], np.float32), model["bias"]


def score(documents: DataFrame, model: tuple[np.ndarray, float], keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` and ``score`` of every row, from its text alone."""
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(*(F.col(c).alias(f"__{c}") for c in keep), F.col("text").cast("string").alias("text"))
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for first, end, data, offsets in slices(text_column(batch)):
                total, times = np.zeros(end - first), np.zeros(end - first)
                for place, buckets in features(data, offsets):
                    sums = np.concatenate([[0.0], np.cumsum(weights[buckets], dtype=np.float64)])
                    cuts = np.searchsorted(place, offsets)
                    total += sums[cuts[1:]] - sums[cuts[:-1]]
                    times += np.diff(cuts)
                out[first:end] = total / np.maximum(times, 1)
            p = 1 / (1 + np.exp(-np.clip(out + bias, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(p)], [*batch.schema.names[:width], "score"])

    own = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:width])
    return rows.mapInArrow(run, f"{own}score double").select(*(F.col(f"__{c}").alias(c) for c in keep), "score")


def classify(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", least: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted) of every document."""
    scored = score(documents, fit(documents, labels, id_col), (id_col,))
    return scored.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))
