"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch are joined to one text. Its suffix array is sorted to the depth of the
longest piece, every piece of the vocabulary is found in it by binary search, and each range of
occurrences gives edges (start, end, piece). Placed by position, the edges are a lattice, which is
then relaxed: for a unigram model along the best score to each position; for a BPE model by merging,
round by round, the neighbours whose common edge has the best score (leftmost on ties). That gives
the ids of the public library for the same model file, byte fallback included.

Words are cut before each run of word marks where no piece of the vocabulary crosses such a place, so
a word is encoded once per task, not once per occurrence.

Defined cases: a null text has null ids, an empty one none; characters without a piece become their
UTF-8 bytes' pieces, or the unknown id where the model has none (neighbouring unknowns are one id); a word mark in the text
reads as a space when decoded, as in the library; invalid byte sequences decode to U+FFFD; extra
columns are passed by. Only models with the identity normalizer are taken.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wayfold.llm.common import small_batches

MARK = "▁"
#: Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
UNIGRAM, BPE = 1, 2
NONE = np.int32(-1)
WORST = np.int64(1 << 40)
GROUP = 1 << 20  # characters of words encoded together
LONG = 256  # words over this many characters are merged with a heap
CACHE = 1_500_000  # words kept in a task


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at : at + size]
        at += size


class Vocabulary:
    def __init__(self, model: bytes) -> None:
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        self.kind, self.prefix, self.squeeze, normalizer = UNIGRAM, True, True, b""
        for number, value in fields(model):
            if number == 1:
                piece = dict(fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.types.append(piece.get(3, NORMAL))
            elif number == 2:
                self.kind = dict(fields(value)).get(3, UNIGRAM)
            elif number == 3:
                spec = dict(fields(value))
                normalizer = spec.get(2, b"")
                self.prefix, self.squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        if normalizer or self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models with the identity normalizer are read")
        if USER_DEFINED in self.types:
            raise ValueError("models with user-defined pieces are not read")
        self.unknown = self.types.index(UNKNOWN) if UNKNOWN in self.types else 0
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.types[i] == BYTE}
        usable = [i for i, t in enumerate(self.types) if t == NORMAL and self.pieces[i]]
        self.ids = np.array(usable, np.int32)
        self.lengths = np.array([len(self.pieces[i]) for i in usable], np.int64)
        self.depth = int(self.lengths.max(initial=1))
        self.codes = np.zeros((len(usable), self.depth), np.uint32)
        for row, i in enumerate(usable):
            self.codes[row, : len(self.pieces[i])] = [ord(c) for c in self.pieces[i]]
        # rank of a piece by score, best first; equal scores have equal ranks
        scores = np.array(self.scores, np.float64)
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        crossing = any(MARK in p[1:].lstrip(MARK) or (p[0] != MARK and MARK in p) for p in (self.pieces[i] for i in usable))
        self.words = re.compile(r"(?s).+" if crossing else f"(?s){MARK}*[^{MARK}]+|{MARK}+$")
        self.out = [self._bytes(i) for i in range(len(self.pieces))]

    def _bytes(self, i: int) -> bytes:
        if self.types[i] == BYTE:
            return bytes([int(self.pieces[i][3:5], 16)])
        if self.types[i] == CONTROL:
            return b""
        return " ⁇ ".encode() if self.types[i] == UNKNOWN else self.pieces[i].replace(MARK, " ").encode()

    def marked(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        return (MARK if self.prefix and text else "") + text.replace(" ", MARK)

    # -- matching ----------------------------------------------------------------------------------

    def lattice(self, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Piece ids by (start, length - 1) for every occurrence that stays in its word."""
        n, depth = len(codes), self.depth
        alphabet, letters = np.unique(codes, return_inverse=True)
        letters = np.concatenate([letters.astype(np.int64) + 1, np.zeros(depth, np.int64)])
        order = suffix_order(letters, n, len(alphabet), depth)
        place = np.searchsorted(alphabet, self.codes)
        known = (place < len(alphabet)) & (alphabet[np.minimum(place, len(alphabet) - 1)] == self.codes)
        inside = np.arange(depth)[None, :] < self.lengths[:, None]
        rows = np.flatnonzero((known | ~inside).all(axis=1))
        wanted, lengths = place[rows] + 1, self.lengths[rows]
        low, high = np.zeros(len(rows), np.int64), np.full(len(rows), n, np.int64)
        for d in range(depth):
            live = np.flatnonzero((lengths > d) & (low < high))
            if not len(live):
                break
            for more, bound in ((0, low), (1, high)):
                left, right = low[live].copy(), high[live].copy()
                target = wanted[live, d] + more
                while (open_ := left < right).any():
                    middle = (left + right) >> 1
                    less = letters[order[np.minimum(middle, n - 1)] + d] < target
                    left = np.where(open_ & less, middle + 1, left)
                    right = np.where(open_ & ~less, middle, right)
                if more:
                    high[live] = left
                else:
                    first = left
            low[live] = first
        counts = np.maximum(high - low, 0)
        ahead = np.cumsum(counts) - counts
        starts = order[np.repeat(low - ahead, counts) + np.arange(counts.sum())]
        which = np.repeat(np.arange(len(rows)), counts)
        fits = starts + lengths[which] <= ends[starts]
        starts, which = starts[fits], which[fits]
        table = np.full((n, depth), NONE, np.int32)
        table[starts, lengths[which] - 1] = self.ids[rows[which]]
        return table

    # -- relaxing ----------------------------------------------------------------------------------

    def merge(self, table: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """BPE: the symbols (start, end) that are left of all words, merged in rounds."""
        depth, rank = self.depth, np.append(self.rank, WORST)
        start, stop, word = np.arange(len(ends)), np.arange(len(ends)) + 1, ends
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(start):
            length = np.concatenate([stop[1:], [0]]) - start
            near = np.concatenate([word[1:] == word[:-1], [False]]) & (length <= depth)
            cost = np.full(len(start), WORST, np.int64)
            at = np.flatnonzero(near)
            cost[at] = rank[table[start[at], length[at] - 1]]
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(cost, first)
            sizes = np.diff(np.append(first, len(start)))
            live = least < WORST
            if not live.all():
                rest = np.repeat(~live, sizes)
                done.append((start[rest], stop[rest]))
            hits = np.flatnonzero((cost == np.repeat(least, sizes)) & np.repeat(live, sizes))
            # the leftmost hit of each word
            owner = np.searchsorted(first, hits, side="right") - 1
            hits = hits[np.concatenate([[True], owner[1:] != owner[:-1]])] if len(hits) else hits
            stop = stop.copy()
            stop[hits] = stop[hits + 1]
            keep = np.repeat(live, sizes)
            keep[hits + 1] = False
            start, stop, word = start[keep], stop[keep], word[keep]
        start, stop = (np.concatenate([d[i] for d in done]) for i in range(2))
        order = np.argsort(start)
        return start[order], stop[order]

    def merge_long(self, table: np.ndarray) -> list[tuple[int, int]]:
        """The same for one long word, with a heap of neighbours."""
        n, depth = len(table), self.depth
        before, stop = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[int, int, int]] = []

        def offer(left: int) -> None:
            right = stop[left]
            if right < n and stop[right] - left <= depth and (piece := table[left, stop[right] - left - 1]) >= 0:
                heapq.heappush(heap, (int(self.rank[piece]), left, stop[right]))

        for i in range(n):
            offer(i)
        alive = bytearray(b"\1" * n)
        while heap:
            _, left, end = heapq.heappop(heap)
            right = stop[left] if alive[left] else n
            if right >= n or stop[right] != end:
                continue
            alive[right] = 0
            stop[left] = end
            if end < n:
                before[end] = left
                offer(left)
            if before[left] >= 0:
                offer(before[left])
        return [(i, stop[i]) for i in range(n) if alive[i]]

    def best_path(self, table: np.ndarray) -> list[tuple[int, int]]:
        """Unigram: edges relaxed by position, best total score; characters without a piece cost more than any."""
        n, least = len(table), min((self.scores[i] for i in self.ids), default=0.0) - 10.0
        best, back = [0.0] + [-np.inf] * n, [0] * (n + 1)
        for at in range(n):
            for k in np.flatnonzero(table[at] >= 0).tolist() or ():
                if (score := best[at] + self.scores[table[at, k]]) > best[at + k + 1]:
                    best[at + k + 1], back[at + k + 1] = score, at
            if table[at, 0] < 0 and best[at] + least > best[at + 1]:
                best[at + 1], back[at + 1] = best[at] + least, at
        path, at = [], n
        while at:
            path.append((back[at], at))
            at = back[at]
        return path[::-1]

    def encode_words(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and where each word's ids end."""
        text = "".join(words)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        sizes = np.array([len(w) for w in words], np.int64)
        cuts = np.cumsum(sizes)
        ends = np.repeat(cuts, sizes)
        table = self.lattice(codes, ends)
        if self.kind == BPE and sizes.max() <= LONG:
            start, stop = self.merge(table, ends)
        else:
            spans = []
            for a, b in zip((cuts - sizes).tolist(), cuts.tolist(), strict=True):
                path = self.merge_long(table[a:b]) if self.kind == BPE else self.best_path(table[a:b])
                spans.extend((a + s, a + e) for s, e in path)
            start, stop = np.array(spans, np.int64).reshape(-1, 2).T
        ids = table[start, stop - start - 1]
        word = np.searchsorted(cuts, start, side="right")
        lost = np.flatnonzero(ids < 0)
        if len(lost):
            times = np.ones(len(ids), np.int64)
            spelled: dict[int, list[int]] = {}
            for i in lost.tolist():
                code = int(codes[start[i]])
                if code not in spelled:
                    spelled[code] = [self.bytes[b] for b in chr(code).encode()] if self.bytes else [self.unknown]
                times[i] = len(spelled[code])
                if not self.bytes and i and ids[i - 1] == self.unknown and word[i] == word[i - 1]:
                    times[i] = 0
                ids[i] = spelled[code][0]
            ids, word = np.repeat(ids, times), np.repeat(word, times)
            at = np.cumsum(times) - times
            for i in lost.tolist():
                if times[i] > 1:
                    ids[at[i] : at[i] + times[i]] = spelled[int(codes[start[i]])]
        return ids, np.cumsum(np.bincount(word, minlength=len(words)))

    def decode(self, ids: Sequence[int]) -> str:
        text = b"".join(map(self.out.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


def suffix_order(letters: np.ndarray, n: int, size: int, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` letters: letters packed to 64 bits, then doubled."""
    bits = max(1, int(size).bit_length())
    reach = max(1, 63 // bits)
    key = np.zeros(n, np.int64)
    for d in range(min(reach, depth)):
        key = (key << bits) | letters[d : d + n] if d < len(letters) - n + 1 else key << bits
    order = np.argsort(key, kind="stable")
    while reach < depth:
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])) + 1
        key = rank * (n + 2)
        key[: max(0, n - reach)] += rank[reach:]
        order = np.argsort(key, kind="stable")
        reach *= 2
    return order


class Encoder:
    """Encodes texts word by word; what a word has been encoded to is kept."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.ids: list[np.ndarray] = []
        self.ends: list[np.ndarray] = []
        self.count = 0

    def learn(self, words: list[str]) -> None:
        group, held = [], 0
        long = [w for w in words if len(w) > LONG]
        for w in [w for w in words if len(w) <= LONG]:
            group.append(w)
            held += len(w)
            if held >= GROUP:
                self.add(group)
                group, held = [], 0
        if group:
            self.add(group)
        for w in long:
            self.add([w])

    def add(self, words: list[str]) -> None:
        ids, ends = self.v.encode_words(words)
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.ids.append(ids)
        self.ends.append(ends + self.count)
        self.count += len(ids)

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and their counts."""
        if len(self.known) > CACHE:
            self.reset()
        find = self.v.words.findall
        split = [find(self.v.marked(t)) for t in texts]
        new = dict.fromkeys(chain.from_iterable(split))
        fresh = [w for w in new if w not in self.known]
        if fresh:
            self.learn(fresh)
        total = sum(map(len, split))
        which = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64, total)
        if len(self.ids) > 1:
            self.ids, self.ends = [np.concatenate(self.ids)], [np.concatenate(self.ends)]
        if not total:
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        ends = self.ends[0]
        begin = np.concatenate([[0], ends[:-1]])[which]
        sizes = ends[which] - begin
        ahead = np.cumsum(sizes) - sizes
        flat = self.ids[0][np.repeat(begin - ahead, sizes) + np.arange(sizes.sum())]
        per_word = np.concatenate([[0], np.cumsum(sizes)])
        cuts = per_word[np.concatenate([[0], np.cumsum([len(w) for w in split])])]
        return flat, np.diff(cuts)


def read_model(path: str) -> bytes:
    """The model file, read by the driver; a vocabulary has a fixed size."""
    with open(path, "rb") as file:
        return file.read()


def _texts(column: pa.Array, each: int = 4_000_000) -> Iterator[tuple[int, list[str | None]]]:
    """Row ranges of about so many characters."""
    rows: list[str | None] = []
    first = held = 0
    for i, text in enumerate(column):
        rows.append(text.as_py())
        held += len(rows[-1] or "")
        if held >= each:
            yield first, rows
            rows, first, held = [], i + 1, 0
    if rows:
        yield first, rows


def encode_documents(documents: DataFrame, model_path: str, id_col: str = "doc_id", keep: Sequence[str] = ()) -> DataFrame:
    """(id, the columns ``keep``, ids array, n_tokens, round_trip) of every row. ``round_trip`` tells whether decoding
    the ids gives the text back; word marks in a text, which decode to spaces, are the one case where it is not so."""
    small_batches(documents.sparkSession)
    model = documents.sparkSession.sparkContext.broadcast(read_model(model_path))
    rows = documents.select(F.col(id_col).alias("__id"), *(F.col(c).alias(f"__{c}") for c in keep), F.col("text").cast("string").alias("text"))
    width = len(keep) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model.value)
        encoder = Encoder(vocabulary)
        for batch in batches:
            for first, texts in _texts(batch.column(width)):
                flat, counts = encoder.encode([t or "" for t in texts])
                nulls = np.array([t is None for t in texts])
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), mask=np.append(nulls, False))
                lists = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))
                same, at, plain = [], 0, flat.tolist()
                for text, count in zip(texts, counts.tolist(), strict=True):
                    same.append(text is not None and vocabulary.decode(plain[at : at + count]) == text)
                    at += count
                part = batch.slice(first, len(texts))
                made = [lists, pa.array(counts.astype(np.int32)), pa.array(same)]
                yield pa.RecordBatch.from_arrays([*part.columns[:width], *made], [*batch.schema.names[:width], "ids", "n_tokens", "round_trip"])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:width])
    done = rows.mapInArrow(run, f"{own}, ids array<int>, n_tokens int, round_trip boolean")
    return done.select(F.col("__id").alias(id_col), *(F.col(f"__{c}").alias(c) for c in keep), "ids", "n_tokens", "round_trip")


def decode_documents(encoded: DataFrame, model_path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, text) from (id, ids); null ids give a null text, ids outside the vocabulary raise an error."""
    model = encoded.sparkSession.sparkContext.broadcast(read_model(model_path))
    rows = encoded.select(F.col(id_col).alias("__id"), F.col("ids").cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model.value)
        for batch in batches:
            texts = [None if ids is None else vocabulary.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["__id", "text"])

    done = rows.mapInArrow(run, f"__id {rows.schema['__id'].dataType.simpleString()}, text string")
    return done.select(F.col("__id").alias(id_col), "text")
