"""Cross-tokenizer alignment against a plain version of its contract."""

import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from sitelens.llm import alignment

A, B = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")
ODD = [None, "", " ", "  a  b ", "a\n b\n\n  c", "x▁y", "x y▁ z", "<|endoftext|> <s> </s>", "日本 語😀 " * 30, "\x00 \x1c  \x85 a\xa0 b", "a" * 5000,
       "é" * 3000 + " ", " " * 300, "\t \t x", "same text", "same text", "the cat the cat the cat"]


def _tokens(first, second):
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    byte_of = {chr(b) if b in shown else chr(next(rest)): b for b in range(256)}
    a_bytes = {i: bytes(byte_of[c] for c in t) for t, i in first.get_vocab(with_added_tokens=False).items()}

    def b_bytes(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()

    return lambda t: [(i, a_bytes[i]) for i in first.encode(" " + t, add_special_tokens=False).ids], lambda t: [(i, b_bytes(i)) for i in second.encode(t)]


def brute(rows):
    """The contract's columns of ``(id, text)`` rows, in their order."""
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    of_a, of_b = _tokens(first, SentencePieceProcessor(model_file=B))
    docs, counts = [], Counter()
    for i, text in rows:
        groups = []
        if text:
            sides = [of_a(text), of_b(text)]
            if all(b"".join(x for _, x in side) == (" " + text).encode() for side in sides):
                ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in sides]
                common = sorted(set(ends[0]) & set(ends[1]))
                made = [defaultdict(list), defaultdict(list)]
                for side, end, held in zip(sides, ends, made, strict=True):
                    for (token, _), e in zip(side, end, strict=True):
                        held[bisect_left(common, e)].append(token)
                groups = [(made[0][g], made[1][g]) for g in range(len(common))]
        links = [(a, b) for x, y in groups for a in x for b in y]
        docs.append((i, groups, links))
        counts.update(set(links))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    digest = lambda gs: hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in gs).encode()).hexdigest() if gs else ""
    return [(i, sum(len(x) for x, _ in gs), sum(len(y) for _, y in gs), len(gs), len(ls), sum(counts[x] == best[x[0]] for x in ls), sum(counts[x] for x in ls), digest(gs)) for i, gs, ls in docs]


def _same(docs):
    got = sorted(map(str, map(tuple, alignment.aligned(docs, A, B).collect())))
    assert got == sorted(map(str, brute([(r.doc_id, r.text) for r in docs.collect()])))


def test_small_table_and_odd_texts(small_documents, documents):
    _same(small_documents.select("doc_id", "text").union(documents([(9000 + i, t) for i, t in enumerate(ODD)]).select("doc_id", "text")))


def test_small_blocks_and_null_ids(documents, monkeypatch):
    monkeypatch.setattr(alignment, "PART", 200)
    monkeypatch.setattr(alignment, "WIDE", 1)
    docs = documents([(None if i % 5 == 0 else i % 7, t) for i, t in enumerate(ODD * 3)])
    _same(docs)
    assert alignment.aligned(documents([]), A, B).count() == 0


def test_counts_of_pairs(documents):
    docs = documents([(1, "the cat the"), (2, "the dog"), (3, "the the the the"), (4, None)])
    _, index = alignment.encoded(docs, A, B)
    got = {r.pair: (r.docs, r.links) for r in alignment.pair_counts(index).collect()}
    first = Tokenizer.from_file(A).encode(" the").ids[0]
    second = SentencePieceProcessor(model_file=B).encode("the")[0]
    assert got[first << alignment.ID_BITS | second] == (3, 7)


@pytest.mark.parametrize("docs", [64, alignment.DOCS])
def test_bitmaps_keep_their_places(docs):
    rng = np.random.default_rng(2)
    sets = [np.flatnonzero(rng.random(docs) < p) for p in (0, 0.001, 0.02, 0.5, 1, 0)]
    maps = alignment.bitmaps(np.array([len(s) for s in sets]), np.concatenate(sets), docs)
    of, place = alignment.places(maps.slice(1))
    for i, s in enumerate(sets[1:]):
        assert sorted(place[of == i]) == s.tolist()
    assert max(map(len, maps.to_pylist())) <= docs // 8 + 1
    assert len(alignment.places(pa.array([], pa.binary()))[0]) == 0
