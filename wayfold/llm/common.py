"""What the operators of this package share: tables kept in the shared folder and small numpy helpers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Text handled at a time inside a task; arrays of a task are a fixed multiple of this.
SLICE_BYTES = 1 << 19
#: Rows in a batch between Spark and Python: texts are long, and several batches of each task are held at once.
BATCH_ROWS = 1000


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``. Where it is unset, a
    local session gets a folder of this machine; any other session is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file:///tmp/checkpoints"
    return root.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def small_batches(spark: SparkSession) -> None:
    """Bounds the memory of operators that hand whole texts to Python; a lower setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def kept(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The frame as a table in the shared folder: it cuts the lineage and outlives lost executors."""
    spark = df.sparkSession
    path = fresh(spark, name)
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of the splitmix64 generator; every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    col = batch.column(batch.schema.get_field_index(name))
    return col.cast(pa.large_string()) if not pa.types.is_large_string(col.type) else col


def slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts a large_string column into row ranges of about ``SLICE_BYTES``: (first row, end row, the
    bytes, the rows' offsets in them). A null text has no bytes; a longer text is a slice of its own."""
    n = len(texts)
    if not n:
        return
    filled = texts.fill_null("") if texts.null_count else texts
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + n + 1]
    data = np.frombuffer(filled.buffers()[2], np.uint8) if filled.buffers()[2] is not None else np.empty(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1
        end = min(n, max(at + 1, end))
        lo, hi = int(offsets[at]), int(offsets[end])
        yield at, end, data[lo:hi], offsets[at : end + 1] - lo
        at = end


class Rolling:
    """Hashes of byte ranges from prefix sums: sum of T[byte] * B**i over the range, times B**-start."""

    B = 0x9E3779B97F4A7C15 | 1
    TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def __init__(self) -> None:
        self.powers = self.inverses = np.ones(1, np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if len(self.powers) <= n:
            size = max(n + 1, SLICE_BYTES + 1)
            inverse = pow(self.B, -1, 1 << 64)
            self.powers = np.full(size, self.B, np.uint64)
            self.inverses = np.full(size, inverse, np.uint64)
            self.powers[0] = self.inverses[0] = 1
            np.cumprod(self.powers, out=self.powers)
            np.cumprod(self.inverses, out=self.inverses)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(self.TABLE[data] * self.powers[:n], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.inverses[start])
