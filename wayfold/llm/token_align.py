"""Cross-tokenizer alignment by inverted pair bitmaps.

Two tokenizers cut the same bytes, a blank and the text. Tokens whose byte ranges overlap are linked; places where
both have a token's end cut a document into groups.

1. Each task tokenizes its documents and marks the ends of both sides in one byte array: an interval between
   neighbouring ends is one link. Documents are numbered in blocks of at most ``BLOCK_DOCS`` (or ``BLOCK_LINKS``
   links); of every slice of text the pairs' documents are OR-merged into the block's bitmaps.
2. A pair of ids has one row per block. Its multiplicity planes are compressed bitmaps of documents: plane k has the
   documents whose number of links has bit k set. The OR of the planes is the pair's document bitmap, and its
   popcount the pair's documents; popcounts weighted by 2**k are the pair's links. Summed over blocks they are
   the corpus-wide counts.
3. The counts join the rows again, and each block's postings return them to its documents.

A pair that all documents hold has one row per block, as any other pair of the block: no key is hot. A block is of
bounded size, and nothing else meets in one task. Only the best count per A id is broadcast; the vocabulary bounds it.

Defined cases: null and empty texts, and those that one of the tokenizers does not give back byte by byte (word marks
of B in a text), have no tokens: zeros and an empty digest; strings of special tokens in a text are plain text; rows with one id, or
none, are separate documents; equal texts count as often as they occur; an empty table gives no rows; extra columns are passed by.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from wayfold.llm.common import kept, small_batches

BLOCK_DOCS = 1 << 15
BLOCK_LINKS = 1 << 22
SLICE_CHARS = 1 << 18
#: From this many documents on a container is a bitmap of the whole block, below it a list of 16-bit numbers.
DENSE = BLOCK_DOCS // 16
#: The byte-level tokenizer's split pattern (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Longest run of white space that the fast library is given; its pattern walks back over such runs.
LONG_BLANK = 10_000

DOCS = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
POSTINGS = "a int, b int, planes array<binary>, n_docs bigint, n_links_pair bigint"


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones are themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    return letters | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in letters.values())}


class ByteTokenizer:
    """A byte-level BPE file; ``table`` has the bytes of each id."""

    def __init__(self, file: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        letters = byte_letters()
        vocabulary = json.loads(file)["model"]["vocab"]
        ranks = {bytes(map(letters.__getitem__, token)): i for token, i in vocabulary.items()}
        self.table = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.table[i] = token
        self.exact = Tokenizer.from_str(file)
        self.exact.encode_special_tokens = True
        # Merges in order of their ids, as here, make the fast library's ids the file's own.
        merges = json.loads(file)["model"]["merges"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in merges)
        made = [vocabulary[a + b] for a, b in pairs]
        self.fast = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}) if made == sorted(made) else None

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return [self._one(t) for t in texts]

    def _one(self, text: str) -> list[int]:
        if self.fast is not None and (len(text) < LONG_BLANK or max(map(len, _blanks(text)), default=0) < LONG_BLANK):
            return self.fast.encode_ordinary(text)
        return self.exact.encode(text, add_special_tokens=False).ids


def _blanks(text: str) -> list[str]:
    import re

    return re.findall(r"\s{100,}", text)


class PieceTokenizer:
    def __init__(self, model: bytes) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(len(self.model))]
        byte = lambda i, p: bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
        self.table = [byte(i, p) for i, p in enumerate(pieces)]

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return self.model.encode(list(texts), num_threads=1)


class Side:
    """One side's tokens of a slice in one array."""

    def __init__(self, ids: list[list[int]], sizes: np.ndarray) -> None:
        self.counts = np.array([len(x) for x in ids], np.int64)
        self.ids = np.fromiter((i for x in ids for i in x), np.int64, int(self.counts.sum()))
        self.ends = np.cumsum(sizes[self.ids])


def numbers(limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of all ids, padded on the right, with room for a separator; and their lengths."""
    text = [str(i).encode() for i in range(limit)]
    width = max(map(len, text)) + 1
    return np.frombuffer(b"".join(t.ljust(width, b"\0") for t in text), np.uint8).reshape(limit, width), np.array([len(t) for t in text])


class Aligner:
    def __init__(self, a: ByteTokenizer, b: PieceTokenizer) -> None:
        self.a, self.b = a, b
        self.sizes = [np.array([len(t) for t in x.table], np.int64) for x in (a, b)]
        self.digits, self.widths = numbers(max(len(a.table), len(b.table)))

    def align(self, texts: Sequence[str | None]) -> tuple[list[tuple], list[bytes], np.ndarray, np.ndarray]:
        """(n_a, n_b, n_groups, n_links) and the written groups of each text; of all links the text's number and the
        pair as A's id times the size of B's vocabulary plus B's id."""
        rows = [i for i, t in enumerate(texts) if t]
        left, right, used = [], [], []
        a_all, b_all = self.a.encode([" " + texts[i] for i in rows]), self.b.encode([texts[i] for i in rows])
        for i, x, y in zip(rows, a_all, b_all, strict=True):
            want = (" " + texts[i]).encode()
            if b"".join(map(self.a.table.__getitem__, x)) == want == b"".join(map(self.b.table.__getitem__, y)):
                left.append(x)
                right.append(y)
                used.append(i)
        counts, groups = [(0, 0, 0, 0)] * len(texts), [b""] * len(texts)
        if not used:
            return counts, groups, np.empty(0, np.int64), np.empty(0, np.int64)
        a, b = Side(left, self.sizes[0]), Side(right, self.sizes[1])
        n = int(a.ends[-1])
        end_a, end_b = np.zeros(n, bool), np.zeros(n, bool)
        end_a[a.ends - 1], end_b[b.ends - 1] = True, True
        cut = np.flatnonzero(end_a | end_b)
        both = end_a & end_b
        # the token of a side that covers a byte: how many of that side end before it
        token_a, token_b = (np.cumsum(e)[cut] - e[cut] for e in (end_a, end_b))
        pair = a.ids[token_a] * len(self.b.table) + b.ids[token_b]
        last = a.ends[np.cumsum(a.counts) - 1] - 1  # last byte of each text
        per = lambda marks: np.diff(np.concatenate([[0], np.cumsum(marks)[last]]))
        n_groups, n_links = per(both), per(end_a | end_b)
        written, cuts = self._written(a, b, both)
        place = np.concatenate([[0], cuts[np.cumsum(n_groups) - 1]])
        for k, i in enumerate(used):
            counts[i] = int(a.counts[k]), int(b.counts[k]), int(n_groups[k]), int(n_links[k])
            groups[i] = written[place[k] : place[k + 1] - 1]  # without the last separator
        return counts, groups, np.repeat(np.array(used), n_links), pair

    def _written(self, a: Side, b: Side, both: np.ndarray) -> tuple[bytes, np.ndarray]:
        """All groups as text, each with a separator behind it, and where each group's text ends."""
        before = np.cumsum(both) - both  # groups that end before a byte
        group_a, group_b = before[a.ends - 1], before[b.ends - 1]
        many = int(both.sum())
        in_a, in_b = np.bincount(group_a, minlength=many), np.bincount(group_b, minlength=many)
        at_a = np.arange(len(group_a)) + (np.cumsum(in_b) - in_b)[group_a]
        at_b = np.arange(len(group_b)) + np.cumsum(in_a)[group_b]
        ids = np.empty(len(at_a) + len(at_b), np.int64)
        ids[at_a], ids[at_b] = a.ids, b.ids
        mark = np.full(len(ids), ord(","), np.uint8)
        ends = np.cumsum(in_a + in_b)
        mark[ends - in_b - 1] = ord("|")
        mark[ends - 1] = ord(";")
        text, width = self.digits[ids], self.widths[ids]
        text[np.arange(len(ids)), width] = mark
        keep = np.arange(text.shape[1])[None, :] <= width[:, None]
        return text[keep].tobytes(), np.cumsum(width + 1)[ends - 1]


def container(docs: np.ndarray) -> bytes:
    """A compressed bitmap: sorted 16-bit numbers, or a bit per document of the block if there are many."""
    if len(docs) < DENSE:
        return docs.astype("<u2").tobytes()
    bits = np.zeros(BLOCK_DOCS, np.uint8)
    bits[docs] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def members(data: bytes) -> np.ndarray:
    if len(data) < 2 * DENSE:
        return np.frombuffer(data, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little"))


class Block:
    """The pair bitmaps of the documents of one block."""

    def __init__(self) -> None:
        self.docs = self.links = 0
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, doc: np.ndarray, pair: np.ndarray, docs: int) -> None:
        keys, times = np.unique(pair << 16 | (doc + self.docs), return_counts=True)
        self.keys.append(keys)
        self.times.append(times)
        self.docs += docs
        self.links += len(keys)

    def rows(self, vocabulary: int) -> tuple[list[pa.Array], int]:
        """Columns a, b, planes, n_docs, n_links_pair. Slices hold different documents, so joining their sorted keys is the OR."""
        keys, times = np.concatenate(self.keys), np.concatenate(self.times)
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
        pairs, first = np.unique(keys >> 16, return_index=True)
        n_docs = np.diff(np.append(first, len(keys)))
        owner = np.repeat(np.arange(len(pairs)), n_docs)
        n_links = np.add.reduceat(times, first) if len(first) else np.empty(0, np.int64)
        most = np.maximum.reduceat(times, first) if len(first) else np.empty(0, np.int64)
        planes = np.floor(np.log2(np.maximum(most, 1))).astype(np.int64) + 1
        slot = np.cumsum(planes) - planes
        doc = (keys & 0xFFFF).astype(np.int64)
        slots, docs = [], []
        for k in range(int(planes.max(initial=0))):
            has = (times >> k & 1).astype(bool)
            slots.append(slot[owner[has]] + k)
            docs.append(doc[has])
        flat_slot, flat_doc = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (slots, docs))
        order = np.argsort(flat_slot, kind="stable")
        flat_slot, flat_doc = flat_slot[order], flat_doc[order]
        sizes = np.bincount(flat_slot, minlength=int(planes.sum()))
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        if (sizes >= DENSE).any():
            data = pa.array([container(flat_doc[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)], pa.binary())
        else:
            data = pa.Array.from_buffers(
                pa.binary(), len(sizes), [None, pa.py_buffer((2 * cuts).astype(np.int32).tobytes()), pa.py_buffer(flat_doc.astype("<u2").tobytes())]
            )
        lists = pa.ListArray.from_arrays(pa.array(np.append(slot, planes.sum()).astype(np.int32)), data)
        ids = [pa.array((x).astype(np.int32)) for x in (pairs // vocabulary, pairs % vocabulary)]
        return [*ids, lists, pa.array(n_docs), pa.array(n_links.astype(np.int64))], len(pairs)


def _slices(column: pa.Array) -> Iterator[list[str | None]]:
    rows: list[str | None] = []
    held = 0
    for text in column:
        rows.append(text.as_py())
        held += len(rows[-1] or "")
        if held >= SLICE_CHARS or len(rows) >= BLOCK_DOCS:
            yield rows
            rows, held = [], 0
    if rows:
        yield rows


def blocks(documents: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", block_docs: int = BLOCK_DOCS, with_groups: bool = False) -> DataFrame:
    """The written table: rows of documents (block, number, counts) and rows of postings (block, pair, planes)."""
    spark = documents.sparkSession
    small_batches(spark)
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:  # vocabularies have a fixed size
        files = spark.sparkContext.broadcast((a.read(), b.read()))
    names = ["block", "number", *(c.split()[0] for c in DOCS.split(", ")), "groups", *(c.split()[0] for c in POSTINGS.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(ByteTokenizer(files.value[0]), PieceTokenizer(files.value[1]))
        task, seq, block = TaskContext.get().partitionId(), 0, Block()
        nulls = lambda n, kinds: [pa.nulls(n, k) for k in kinds]
        doc_kinds = [pa.int32(), *[pa.int64()] * 5, pa.string(), pa.string()]
        post_kinds = [pa.int32(), pa.int32(), pa.list_(pa.binary()), pa.int64(), pa.int64()]

        def closed() -> Iterator[pa.RecordBatch]:
            if block.links:
                columns, n = block.rows(len(aligner.b.table))
                table = pa.RecordBatch.from_arrays([pa.array([task << 32 | seq] * n, pa.int64()), *nulls(n, doc_kinds), *columns], names)
                for at in range(0, n, 20_000):
                    yield table.slice(at, 20_000)

        for batch in batches:
            at = 0
            for texts in _slices(batch.column(1)):
                if block.docs and (block.docs + len(texts) > min(block_docs, BLOCK_DOCS) or block.links > BLOCK_LINKS):
                    yield from closed()
                    seq, block = seq + 1, Block()
                counts, groups, doc, pair = aligner.align(texts)
                sha = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
                n = len(texts)
                own = [pa.array([task << 32 | seq] * n, pa.int64()), pa.array(range(block.docs, block.docs + n), pa.int32()), batch.column(0).slice(at, n)]
                own += [pa.array([c[k] for c in counts], pa.int64()) for k in range(4)] + [pa.array(sha)]
                own.append(pa.array([g.decode() for g in groups]) if with_groups else pa.nulls(n, pa.string()))
                yield pa.RecordBatch.from_arrays([*own, *nulls(n, post_kinds)], names)
                block.add(doc, pair, n)
                at += n
        yield from closed()

    rows = documents.select(F.col(id_col).cast("bigint").alias("__id"), F.col("text").cast("string").alias("text"))
    return kept(rows.mapInArrow(run, f"block bigint, number int, {DOCS}, groups string, {POSTINGS}"), "aligned")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, n_docs, n_links, best) of every linked pair of ids; ``best`` if no pair of its A id is in more documents."""
    pairs = aligned.where("a IS NOT NULL").groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links_pair").alias("n_links"))
    most = pairs.groupBy("a").agg(F.max("n_docs").alias("most"))  # at most a row per id of A's vocabulary
    return pairs.join(F.broadcast(most), "a").select("a", "b", "n_docs", "n_links", (F.col("n_docs") == F.col("most")).alias("best"))


def _returned(docs: pa.Table, postings: pa.Table) -> pa.Table:
    """The scores of one block's documents from its postings."""
    numbers_ = docs.column("number").to_numpy()
    size = int(numbers_.max(initial=-1)) + 1
    best, total = np.zeros(size, np.int64), np.zeros(size, np.int64)
    if postings.num_rows:
        planes = postings.column("planes").combine_chunks()
        lists = planes.flatten().to_pylist()
        length = planes.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        owner = np.repeat(np.arange(len(length)), length)
        power = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length)
        found = [members(x) for x in lists]
        sizes = np.array([len(x) for x in found])
        doc = np.concatenate(found)
        owner, times = np.repeat(owner, sizes), np.repeat(np.int64(1) << power, sizes)
        np.add.at(total, doc, times * postings.column("count").to_numpy()[owner])
        np.add.at(best, doc, times * postings.column("best").to_numpy(zero_copy_only=False)[owner])
    return docs.drop_columns(["block", "number"]).append_column("n_best", pa.array(best[numbers_])).append_column("count_sum", pa.array(total[numbers_]))


def align_documents(documents: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", block_docs: int = BLOCK_DOCS, with_groups: bool = False) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row, and ``groups`` on request."""
    return score(blocks(documents, path_a, path_b, id_col, block_docs, with_groups), id_col, with_groups)


def score(aligned: DataFrame, id_col: str = "doc_id", with_groups: bool = False) -> DataFrame:
    counts = pair_counts(aligned).select("a", "b", F.col("n_docs").alias("count"), "best")
    postings = aligned.where("a IS NOT NULL").select("block", "a", "b", "planes").join(counts, ["a", "b"])
    postings = postings.select(F.col("block").alias("home"), "planes", "count", "best")
    names = [c.split()[0] for c in DOCS.split(", ")] + ["groups"] * with_groups
    docs = aligned.where("number IS NOT NULL").select("block", "number", *names)
    schema = f"{DOCS}{', groups string' * with_groups}, n_best bigint, count_sum bigint"
    done = docs.groupBy("block").cogroup(postings.groupBy("home")).applyInArrow(_returned, schema)
    out = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *["groups"] * with_groups]
    return done.select(F.col("doc_id").alias(id_col), *out)
