"""BPE by forced boundaries against the tokenizers library."""

import random

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from sitelens.llm import bpe

FILE = path("word_bpe_49k.json")
ODD = [None, "", "  \n", "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>", "ΟΔΟΣ Σ.", "á é", "a ́b", "日本語 テスト " * 20, "x" * 20_000, "ab" * 20_000, "ẛ̣ K İ ſ", "\x1c\x1d a\x1eb", "it's IT'S o'Re"]


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(FILE)
    made.no_truncation()
    made.no_padding()
    return made


def _want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)


def test_random_texts(library, monkeypatch):
    monkeypatch.setattr(bpe, "PART", 7)
    made = bpe.Encoder(FILE)
    rng = random.Random(1)
    pool = [*range(32, 127), *range(0xA0, 0x250), *range(0x300, 0x330), 0x2019, 0x2014, 0x20AC, 0x3042, 0x4E00, 0x1F600, 9, 10, 13, 0x85, 0x2028, 0x1C, 0x3A3]
    for _ in range(4000):
        text = "".join(chr(rng.choice(pool)) for _ in range(rng.randint(1, 40)))
        got = made.encode(text)
        assert (got, made.decode(got)) == _want(library, text), text


def test_every_plain_character(library):
    made = bpe.Encoder(FILE)
    for c in range(0x3000):
        if bpe.PLAIN.fullmatch(chr(c)):
            text = f"a{chr(c)}B1{chr(c)}{chr(c)} {chr(c)}'s"
            assert made.encode(text) == _want(library, text)[0], hex(c)


def test_maps_may_be_small(library, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS", 3)
    monkeypatch.setattr(bpe, "FRAGMENTS", 2)
    made, text = bpe.Encoder(FILE), "one two three four five six one two three supercalifragilistic"
    assert made.encode(text) == _want(library, text)[0]


def test_table(library, documents, small_documents):
    rows = [(None if i == 3 else i, t) for i, t in enumerate(ODD)] + [(1, "twice"), (1, "twice")]
    docs = documents(rows)
    ids = bpe.encoded(docs, FILE)
    got = sorted(map(str, map(tuple, bpe.decoded(ids, FILE, carried=True).collect())))
    want = [(i, *_want(library, t)) for i, t in rows]
    assert got == sorted(str((i, bytearray(a) if isinstance(ids.first().ids, bytearray) else a, b)) for i, a, b in want)
    assert bpe.encoded(documents([]), FILE).count() == 0
    given = {r.doc_id: r.text for r in small_documents.collect()}
    for r in bpe.encoded(small_documents, FILE).collect():
        assert bytes(r.ids) == _want(library, given[r.doc_id])[0]
