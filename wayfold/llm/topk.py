"""Exact top-k by inner product with a vector-approximation file.

Every component x becomes floor(scale * x). The file holds one row per block of vectors: each component as a
byte, the number of one of CELLS equal steps between the block's least and largest value, and per component the
middle of the first step, the step, and how far a value lies from the middle of its step at most. One product with the bytes
gives a score, and these distances bound its error, for all vectors of the block at once; the vectors themselves are not touched.

1. The file is dealt out in groups of blocks that a task can hold, once for each of few parts of the queries. A task reads
   its group and then the blocks of its part of the queries one by one, so what is moved and held hangs on groups and parts,
   not on pairs of blocks. Candidates whose upper bound reaches the kth lower bound of the blocks seen before in the group go
   on as ids with both bounds.
2. The kth lower bound over all blocks rules out most of them.
3. Exact vectors are read in the order of the upper bounds of the rest: the first 2k per query (and those as high), and then
   those whose upper bound still reaches the kth exact score. Beyond these the result is certain. The places in that order that
   matter come from ranks that Spark limits before the shuffle, so a query with many near vectors is no task of its own.

Of equal vectors the file holds the k + 1 with the smallest ids: no other can be among k results, so that one very
common vector costs no more than any other. Scores are exact whole numbers: sums that could leave 53 bits are computed with Python integers.

Defined cases: a null vector or one with a null or non-finite component takes no part, neither as
query nor as candidate, and so does a row without id; equal rows (id and vector) are one query, and as
candidates as many results as there are rows; vectors of different lengths do not meet; ties go to
the smaller id; scores beyond a long are cut to its range; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from wayfold.llm.common import kept

CELLS = 256  # one byte
QUERIES = 256  # in a block
CANDIDATES = 2048
COMPONENTS = 1 << 18  # in a block of either kind, about
GROUP = 1 << 26  # components of the file that a task holds, about
PART = 1 << 24  # components of the queries that a task reads, about
LEAST_GROUPS, LEAST_PARTS = 32, 2  # or as many as there are blocks, even if groups and parts are smaller
SINGLE = 4096  # components up to which products are of single precision
BATCH = "8m"  # blocks handed to Python at a time
HELD = 1 << 19  # candidates of a block of queries that wait for a higher floor
QUERY = ["query_id", "query_key"]
TASK = ["dim", "part", "grp"]
LEAST, MOST = -(2**63), 2**63 - 1


def whole(column, scale: int):
    return F.transform(column, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))


def _file_row(at: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """A block of vectors as a row of the file."""
    c = np.stack(rows["v"].to_numpy())
    low, high = c.min(axis=0), c.max(axis=0)
    step = np.maximum((high - low) / CELLS, 1e-300)
    cell = np.clip((c - low) / step, 0, CELLS - 1).astype(np.uint8)
    middle = low + step / 2
    off, size = np.abs(c - (middle + cell * step)).max(axis=0), np.abs(c).max(axis=0)
    numbers = (rows["id"].to_numpy(np.int64), rows["key"].to_numpy(np.int64), cell, middle, step, off, size)
    return pd.DataFrame([(*at, *(x.tobytes() for x in numbers))])


def _query_row(at: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    numbers = (rows["id"].to_numpy(np.int64), rows["key"].to_numpy(np.int64), np.stack(rows["v"].to_numpy()))
    return pd.DataFrame([(*at, *(x.tobytes() for x in numbers))])


def _near(query_id: np.ndarray, q: np.ndarray, blocks: list[tuple], k: int) -> Iterator[tuple]:
    """(query's place, candidate's id, key, upper, lower) of the candidates in the blocks that can be among the best k of the queries."""
    floor, best_of, best = np.full(len(q), -np.inf), np.empty(0, np.int64), np.empty(0)
    size_of_q, found, held = np.abs(q), [], 0
    for ids, keys, cell, middle, step, off, size in blocks:
        reach = size_of_q @ step * CELLS
        # The second term is beyond the rounding of sums of up to a million components.
        error = size_of_q @ off + 1e-9 * (size_of_q @ size)
        kind = np.float32 if q.shape[1] <= SINGLE and reach.max() < 1e30 else np.float64
        if kind is np.float32:
            error += (q.shape[1] + 4) * 2.0**-23 * reach  # beyond the rounding of factors and sums
        base, score = q @ middle, (q * step).astype(kind) @ cell.astype(kind).T
        if len(ids) >= k and np.isneginf(floor).any():
            others = np.where(query_id[:, None] == ids[None, :], np.inf, -score)
            floor = np.maximum(floor, np.clip(base - np.partition(others, k - 1, axis=1)[:, k - 1] - error, -np.inf, MOST))
        with np.errstate(over="ignore"):
            least = (np.where(floor <= LEAST, -np.inf, floor) - error - base).astype(kind)
        r, place = np.divmod(np.flatnonzero(score >= np.nextafter(least, kind(-np.inf))[:, None]), len(ids))
        near = base[r] + score[r, place]
        upper, lower = np.clip(near + error[r], LEAST, MOST), np.clip(near - error[r], LEAST, MOST)
        fits = (upper >= floor[r]) & (ids[place] != query_id[r])
        r, place, upper, lower = r[fits], place[fits], upper[fits], lower[fits]
        found.append((r, ids[place], keys[place], upper, lower))
        held += len(r)
        if (higher := lower > floor[r]).any():
            best_of, best = np.concatenate([best_of, r[higher]]), np.concatenate([best, lower[higher]])
            order = np.lexsort((-best, best_of))
            best_of, best = best_of[order], best[order]
            rank = np.arange(len(best)) - np.searchsorted(best_of, best_of)
            last = rank == k - 1
            floor[best_of[last]] = np.maximum(floor[best_of[last]], best[last])
            best_of, best = best_of[rank < k], best[rank < k]
        if held > HELD:
            found = [_over(found, floor)]
            held = len(found[0][0])
            if held > HELD // 2:
                yield found.pop()
                held = 0
    if found:
        yield _over(found, floor)


def _over(found: list[tuple], floor: np.ndarray) -> tuple:
    joined = [np.concatenate(x) for x in zip(*found, strict=True)]
    fits = joined[3] >= floor[joined[0]]
    return tuple(x[fits] for x in joined)


def _bounds(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(query, candidate, bounds of its score) of the candidates of each group that can be among the best k; its blocks come before the queries."""
    met, blocks = None, []
    for batch in batches:
        column = dict(zip(batch.schema.names, batch.columns, strict=True))
        for i in range(batch.num_rows):
            numbers = lambda name, kind=np.float64: np.frombuffer(column[name][i].as_buffer(), kind)  # noqa: B023, E731
            if met != (now := tuple(column[x][i].as_py() for x in TASK)):
                met, blocks = now, []
            ids, keys = numbers("ids", np.int64), numbers("keys", np.int64)
            if not column["asks"][i].as_py():
                cell = numbers("cell", np.uint8).reshape(len(ids), -1)
                blocks.append(tuple(x.copy() for x in (ids, keys, cell, *map(numbers, ("middle", "step", "off", "size")))))
                continue
            for r, vec_id, vec_key, upper, lower in _near(ids, numbers("q").reshape(len(ids), -1), blocks, k):
                made = (ids[r], keys[r], vec_id, vec_key, upper, lower)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], [*QUERY, "vec_id", "vec_key", "upper", "lower"])


def _scores(pairs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in pairs:
        made = np.empty(len(batch), np.int64)
        for i, (q, c) in enumerate(zip(batch["q"], batch["v"], strict=True)):
            if float(np.abs(q).max()) * float(np.abs(c).max()) * len(q) < 2**52:
                made[i] = int(q @ c)
            else:
                made[i] = min(max(sum(int(x) * int(y) for x, y in zip(q, c, strict=True)), LEAST), MOST)
        yield batch[[*QUERY, "vec_id", "times"]].assign(score=made)


def _kth(rows: DataFrame, value: str, k: int) -> DataFrame:
    """The kth largest value of each query that has as many, as ``least``."""
    order = Window.partitionBy(*QUERY).orderBy(F.desc(value))
    best = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.groupBy(*QUERY).agg(F.min(value).alias("least"), F.count("*").alias("n")).where(F.col("n") == k).drop("n")


def _can_win(rows: DataFrame, least: DataFrame) -> DataFrame:
    return rows.join(least, QUERY, "left").where(F.col("least").isNull() | (F.col("upper") >= F.col("least"))).drop("least")


@contextmanager
def _batches_of(spark: SparkSession, size: str) -> Iterator[None]:
    """What runs inside hands at most about ``size`` to Python at a time; then the setting is as before."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def approximate(rows: DataFrame, every: int, k: int) -> DataFrame:
    """Steps 1 and 2: (query, candidate, upper) of the candidates that can win, from the file alone."""
    counted = rows.agg(F.count("*").alias("n"), F.sum(F.size("v")).alias("c"), F.count_if(F.col("id") % every == 0).alias("q")).first()
    long = (counted["c"] or 0) // max(1, counted["n"])
    share = max(1, long // (COMPONENTS // CANDIDATES))
    blocks, asking = max(1, -(-counted["n"] * share // CANDIDATES)), max(1, -(-counted["q"] * share // QUERIES))
    groups = min(blocks, max(LEAST_GROUPS, -(-(counted["c"] or 0) // GROUP)))
    parts = min(asking, max(LEAST_PARTS, -(-counted["q"] * long // PART)))
    dim, spread = F.size("v").alias("dim"), lambda n: F.pmod("key", F.lit(n)).cast("int").alias("block")
    least_ids = Window.partitionBy(F.xxhash64("v"), "v").orderBy("id")
    filed = rows.withColumn("nth", F.row_number().over(least_ids)).where(F.col("nth") <= k + 1).select("id", "key", "v", dim, spread(blocks))
    held = "ids binary, keys binary, cell binary, middle binary, step binary, off binary, size binary"
    file = filed.groupBy("dim", "block").applyInPandas(_file_row, f"dim int, block int, {held}")
    file = kept(file, "approximation", **{"parquet.block.size": str(1 << 23)})  # a reader holds many rows of a row group
    asked = rows.where(F.col("id") % every == 0).select("id", "key", "v", dim, spread(asking))
    asked = asked.groupBy("dim", "block").applyInPandas(_query_row, "dim int, block int, ids binary, keys binary, q binary")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    file = file.withColumn("grp", F.col("block") % groups).withColumn("part", each(parts)).withColumn("asks", F.lit(False))
    asked = asked.withColumn("part", F.col("block") % parts).withColumn("grp", each(groups)).withColumn("asks", F.lit(True))
    both, tasks = file.unionByName(asked, allowMissingColumns=True), groups * parts
    dealt = both.repartitionById(tasks, F.pmod(F.col("dim") + F.col("part") * groups + F.col("grp"), F.lit(tasks)).cast("int"))
    made = "query_id bigint, query_key bigint, vec_id bigint, vec_key bigint, upper double, lower double"
    near = dealt.sortWithinPartitions(*TASK, "asks").mapInArrow(lambda batches: _bounds(batches, k), made)
    with _batches_of(rows.sparkSession, BATCH):
        found = kept(near, "bounds")
    return _can_win(found.drop("lower"), _kth(found, "lower", k))


def read(near: DataFrame, rows: DataFrame, every: int) -> DataFrame:
    """(query, vec_id, times, score) with the exact vectors of both sides."""
    queries = rows.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), F.col("key").alias("query_key"), F.col("v").alias("q"))
    vectors = rows.select(F.col("id").alias("vec_id"), F.col("key").alias("vec_key"), "v", "times")
    met = near.select(*QUERY, "vec_id", "vec_key").join(vectors, ["vec_id", "vec_key"]).join(queries, QUERY)
    return met.select(*QUERY, "vec_id", "times", "q", "v").mapInPandas(_scores, "query_id bigint, query_key bigint, vec_id bigint, times bigint, score bigint")


def usable(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, v, times, key) of the distinct rows that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("v")).where(
        "id IS NOT NULL AND v IS NOT NULL AND size(v) > 0"
    )
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = rows.where(F.coalesce(fine, F.lit(False))).select("id", whole(v, scale).alias("v"))
    return rows.groupBy("id", "v").agg(F.count("*").alias("times")).withColumn("key", F.xxhash64("id", "v"))


def top_k(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 50, scale: int = 256, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows whose id is divisible by ``every`` against all rows."""
    rows = kept(usable(vectors, id_col, vec_col, scale), "vectors")
    near = kept(approximate(rows, every, k), "near")
    early = kept(_kth(near, "upper", 2 * k), "early")
    first = kept(read(_can_win(near, early), rows, every), "read")
    later = near.join(early, QUERY).where(F.col("upper") < F.col("least")).drop("least")
    rest = read(_can_win(later, _kth(first, "score", k)), rows, every)
    copies = F.explode(F.array_repeat(F.lit(1), F.least("times", F.lit(k)).cast("int")))
    found = first.union(rest).withColumn("copy", copies)
    order = Window.partitionBy(*QUERY).orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
