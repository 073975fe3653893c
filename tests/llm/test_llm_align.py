"""Cross-tokenizer alignment against a plain walk over both tokenizers' tokens."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from wayfold.llm import cases, token_align

DOCS = "doc_id long, text string, block long, number int, planes string"


class Walk:
    """The contract by one pass over each document's tokens."""

    def __init__(self, rows):
        tokenizers = pytest.importorskip("tokenizers")
        sentencepiece = pytest.importorskip("sentencepiece")
        left = tokenizers.Tokenizer.from_file(cases.BYTES)
        left.encode_special_tokens = True
        right = sentencepiece.SentencePieceProcessor(model_file=cases.MODEL)
        letters = token_align.byte_letters()
        self.rows, self.links, self.holders = [], [], defaultdict(set)
        for k, (i, text) in enumerate(rows):
            want = b" " + (text or "").encode()
            a = left.encode(" " + text, add_special_tokens=False).ids if text else []
            b = right.encode(text) if text else []
            a_bytes = [bytes(letters[c] for c in left.id_to_token(x)) for x in a]
            b_bytes = [bytes([int(right.id_to_piece(x)[3:5], 16)]) if right.is_byte(x) else right.id_to_piece(x).replace("▁", " ").encode() for x in b]
            links, groups = [], []
            if text and b"".join(a_bytes) == want == b"".join(b_bytes):
                x = y = 0
                end_a, end_b = len(a_bytes[0]), len(b_bytes[0])
                own_a, own_b = [a[0]], [b[0]]
                while True:
                    links.append((a[x], b[y]))
                    step_a, step_b = end_a <= end_b, end_b <= end_a
                    if step_a and step_b:
                        groups.append(",".join(map(str, own_a)) + "|" + ",".join(map(str, own_b)))
                        own_a, own_b = [], []
                        if x + 1 == len(a):
                            break
                    if step_a:
                        x += 1
                        end_a += len(a_bytes[x])
                        own_a.append(a[x])
                    if step_b:
                        y += 1
                        end_b += len(b_bytes[y])
                        own_b.append(b[y])
            else:
                a, b = [], []
            for p in links:
                self.holders[p].add(k)
            self.links.append(links)
            self.rows.append((i, len(a), len(b), len(groups), len(links), ";".join(groups)))
        self.most = defaultdict(int)
        for (x, _), d in self.holders.items():
            self.most[x] = max(self.most[x], len(d))

    def scored(self):
        out = Counter()
        for (*counts, groups), links in zip(self.rows, self.links, strict=True):
            best = sum(len(self.holders[p]) == self.most[p[0]] for p in links)
            total = sum(len(self.holders[p]) for p in links)
            out[(*counts, best, total, hashlib.sha256(groups.encode()).hexdigest() if groups else "")] += 1
        return out


def texts():
    rng = random.Random(5)
    words = ["the", "of", "tokenization", "<|endoftext|>", "<s>", "</s>", "<0x41>", "naïve", "漢字", "\U0001f600", "\n", "  ", "\t", "don't", "3.14", "\0", "\x85"]
    out = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(120)]
    out += ["", None, " ", "a▁b", "▁", " lead", "trail ", "same text"] + ["same text"] * 5 + ["the " * 3000, " " * 30_000 + "x", "ab" * 20_000, "é" * 5000]
    return [(n if n % 11 else None, t) for n, t in enumerate(out)] + [(3, "again"), (3, "again")]


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, 1, 2, "clash") for r in rows], DOCS).repartition(parts)


@pytest.mark.parametrize("block_docs", [token_align.BLOCK_DOCS, 7])
def test_alignment_equals_a_plain_walk(spark, block_docs, monkeypatch):
    if block_docs == 7:
        monkeypatch.setattr(token_align, "SLICE_CHARS", 400)
        monkeypatch.setattr(token_align, "DENSE", 3)
    rows = texts()
    walk = Walk(rows)
    got = token_align.align_documents(frame(spark, rows), cases.BYTES, cases.MODEL, block_docs=block_docs)
    assert Counter(map(tuple, got.collect())) == walk.scored()


def test_pair_counts_and_groups(spark):
    rows = texts()
    walk = Walk(rows)
    aligned = token_align.blocks(frame(spark, rows), cases.BYTES, cases.MODEL, with_groups=True)
    links = Counter(p for own in walk.links for p in own)
    want = {p: (len(d), links[p], len(d) == walk.most[p[0]]) for p, d in walk.holders.items()}
    assert {(r.a, r.b): (r.n_docs, r.n_links, r.best) for r in token_align.pair_counts(aligned).collect()} == want
    groups = Counter((r.doc_id, r.groups) for r in token_align.score(aligned, with_groups=True).collect())
    assert groups == Counter((r[0], r[-1]) for r in walk.rows)


def test_query_equals_a_plain_walk_on_whole_texts(spark):
    from oracle import sf_dir

    small = sf_dir("0.001")
    rows = [tuple(r) for r in cases.table(spark, small, "documents").select("doc_id", "text").collect()]
    assert Counter(map(tuple, cases.op13_token_alignment(spark, small).collect())) == Walk(rows).scored()


def test_bitmaps():
    rng = np.random.default_rng(2)
    for n in (0, 1, token_align.DENSE - 1, token_align.DENSE, 20_000, token_align.BLOCK_DOCS):
        docs = np.sort(rng.choice(token_align.BLOCK_DOCS, n, replace=False))
        data = token_align.container(docs)
        assert token_align.members(data).tolist() == docs.tolist()
        assert len(data) <= token_align.BLOCK_DOCS // 8
    block = token_align.Block()
    block.add(np.array([0, 0, 0, 1]), np.array([5, 5, 5, 5]), 2)
    block.add(np.array([0, 1, 1]), np.array([5, 5, 9]), 2)
    (a, b, planes, n_docs, n_links), n = block.rows(4)
    assert (n, a.to_pylist(), b.to_pylist(), n_docs.to_pylist(), n_links.to_pylist()) == (2, [1, 2], [1, 1], [4, 1], [6, 1])
    # document 0 has three links: bits 0 and 1
    assert [[token_align.members(x).tolist() for x in row] for row in planes.to_pylist()] == [[[0, 1, 2, 3], [0]], [[3]]]


def test_tables_without_tokens(spark):
    none = frame(spark, [])
    assert token_align.align_documents(none, cases.BYTES, cases.MODEL).count() == 0
    got = token_align.align_documents(frame(spark, [(1, None), (1, ""), (None, "a▁")]), cases.BYTES, cases.MODEL).collect()
    assert Counter(map(tuple, got)) == Counter([(1, 0, 0, 0, 0, 0, 0, "")] * 2 + [(None, 0, 0, 0, 0, 0, 0, "")])
