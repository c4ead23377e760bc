"""Best-fit packing (best-two-fit) of documents into token sequences.

Texts become token ids; a document longer than a sequence is cut into pieces
of the sequence's length, of which the first may be shorter.  Pieces are dealt
by a hash into shards of about ``SHARD`` pieces and each shard is packed on its
own: a bin is filled greedily with the longest pieces that fit; then its
smallest piece is replaced by the two unpacked pieces that fill the gap left
without it best, where they fill it tighter.  Within a shard the work is on the
histogram of lengths, so it is near linear in the pieces.

Defined results: a null text is empty and gives the end token alone; repeated
rows are packed each; an empty table gives an empty result; pieces of one
length are taken in the order of their identifying columns.  Columns beyond
those named are not read."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import mapped, ship, spread

CAPACITY = 2048
#: Pieces of a shard, on average: about 30 MB with their token ids.
SHARD = 1 << 13
#: Token ids that one Arrow batch of pieces holds, about.
BATCH_IDS = 1 << 20
#: The id that ends a document.
END = 0


@lru_cache(maxsize=4)
def encoder(path: str, added: bool = False) -> Callable[[str], np.ndarray]:
    """Text to uint32 ids by a byte-level BPE file of ``tokenizers``.

    The file's vocabulary, as byte strings with their ids as ranks, goes to
    tiktoken's implementation of the same merges: equal ids (tested against
    ``tokenizers``) in a quarter of the time.  With ``added``, the strings of the
    file's added tokens become their ids, as the library's default is; else
    they are ordinary text (its ``encode_special_tokens``).  A text that
    tiktoken's expression cannot take (very long white space) goes to the library."""
    import tiktoken
    from public_tokenizers import PATTERN

    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that byte-level BPE writes as themselves
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    file = json.loads(Path(path).read_text(encoding="utf-8"))
    special = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
    if added and any(t[k] for t in file.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{path}: added tokens that look at the text around them")
    ranks = {bytes(byte_of[c] for c in token): i for token, i in file["model"]["vocab"].items() if token not in special}
    made = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special if added else {})
    library: list = []

    def encode(text: str) -> np.ndarray:
        try:
            return made.encode_to_numpy(text, allowed_special="all", disallowed_special=())
        except ValueError as error:  # its regular expression has a bounded stack: over some 300,000 white spaces in a row
            if "Regex error" not in str(error):
                raise
        if not library:
            from tokenizers import Tokenizer

            library.append(Tokenizer.from_file(path))
            library[0].encode_special_tokens = not added
            library[0].no_truncation()
            library[0].no_padding()
        return np.array(library[0].encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", added: bool = False) -> DataFrame:
    """``id_col, piece, start, length, ids`` of every piece; ``ids`` are little-endian
    unsigned 32-bit integers, by ``encoder(tokenizer, added)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, added)
        for b in batches:
            rows, held = [], 0
            for key, text in zip(b.column(0), b.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END)).astype("<u4")
                first = len(ids) % capacity or min(capacity, len(ids))
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                rows += [(key.as_py(), i, s, e - s, ids[s:e].tobytes()) for i, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False))]
                held += len(ids)
                if held >= BATCH_IDS:
                    yield _batch(rows, b.schema.field(0).type)
                    rows, held = [], 0
            yield _batch(rows, b.schema.field(0).type)

    def _batch(rows: list, key: pa.DataType) -> pa.RecordBatch:
        kinds = (key, pa.int32(), pa.int64(), pa.int64(), pa.binary())
        cols = list(zip(*rows, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [id_col, "piece", "start", "length", "ids"])

    given = spread(docs).select(id_col, text_col)
    return mapped(given, run, f"`{id_col}` {given.schema[0].dataType.simpleString()}, piece int, start long, length long, ids binary")


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """``bin, offset`` of each item.  Items of a length are interchangeable, so
    the search is on ``count`` (items left of each length) and ``fit`` (the
    largest length left that is at most x, 0 for none)."""
    if len(lengths) and (lengths.max() > capacity or lengths.min() < 1):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    count = np.bincount(lengths, minlength=capacity + 1)
    fit = np.maximum.accumulate(np.where(count > 0, np.arange(capacity + 1), 0))
    bins: list[list[int]] = []

    def take(x: int) -> None:
        count[x] -= 1
        if not count[x]:
            fit[x : np.searchsorted(fit, x, "right")] = fit[x - 1]

    while fit[capacity]:
        one, gap = [], capacity

        def fill() -> None:
            nonlocal gap
            while x := int(fit[gap]):
                take(x)
                one.append(x)
                gap -= x

        fill()
        if gap and fit[capacity]:
            room = gap + one[-1]  # what the smallest leaves free
            longer = np.flatnonzero(count[: room + 1])
            other = fit[room - longer]
            same = (other == longer) & (count[longer] < 2)
            other[same] = fit[longer[same] - 1]
            total = np.where(other > 0, longer + other, 0)
            best = int(total.argmax()) if len(total) else -1
            if best >= 0 and total[best] > one[-1]:
                small = one.pop()
                for x in (int(longer[best]), int(other[best])):
                    take(x)
                    one.append(x)
                count[small] += 1
                np.maximum(fit[small:], small, out=fit[small:])
                gap = room - int(total[best])
                fill()
        bins.append(one)

    flat = np.fromiter((x for one in bins for x in one), np.int64, len(lengths))
    number = np.repeat(np.arange(len(bins)), [len(one) for one in bins])
    before = np.cumsum(flat) - flat
    offset = before - before[np.flatnonzero(np.diff(number, prepend=-1))][number] if len(flat) else flat
    bin_of, offset_of = np.empty(len(flat), np.int64), np.empty(len(flat), np.int64)
    items, places = np.argsort(lengths, kind="stable"), np.argsort(flat, kind="stable")
    bin_of[items], offset_of[items] = number[places], offset[places]
    return bin_of, offset_of


def packed(given: DataFrame, keys: list[str], rows: int, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``given`` with ``sequence_id`` and ``offset``.  ``keys`` identify a piece
    (repeated rows are interchangeable); ``rows`` is the number of rows, which
    sets the number of shards."""
    shards = max(1, -(-rows // SHARD))
    ship(given.sparkSession)

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard_")[0].as_py()
        table = table.drop_columns("shard_").sort_by([(k, "ascending") for k in [length, *keys]])
        bin_of, offset = best_two_fit(table.column(length).to_numpy().astype(np.int64), capacity)
        table = table.append_column("sequence_id", pa.array(bin_of + (shard << 32)))
        return table.append_column("offset", pa.array(offset))

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields] + ["sequence_id long", "offset long"])
    return given.withColumn("shard_", F.pmod(F.xxhash64(*keys), F.lit(shards))).groupBy("shard_").applyInArrow(run, schema)
