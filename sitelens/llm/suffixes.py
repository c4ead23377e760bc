"""Repeated substrings, exactly: every byte that a ``LENGTH``-byte string
covers which also starts earlier (smaller id, or earlier in the same text).

The construction is blockwise over a cover sample of the suffixes: two
suffixes with the same first LENGTH bytes reach a sampled suffix after the same
number of bytes, so sampled suffixes' ranks settle the ties of all others.  Two
covers have that property:

``difference``: places whose residue modulo ``MODULUS`` is in a difference cover
(each difference of two places is one of two residues): 12 % of the places, and
every string reaches nine of them.
``content``: the place with the smallest hash of ``WORD`` bytes among those in a
string: under 3 % of the places, and every string reaches one.  Results are
equal; it is the default as the other's sample alone is over the disk limit
of the check (see the README for the figures).

1. *Buckets.*  Sampled suffixes go to the bucket of their first WORD bytes.  A
   bucket with one suffix has no repeat and leaves.
2. *Ranks.*  Suffixes of a bucket with equal context (all bytes of all strings
   that reach this sampled suffix) have one rank, its place the earliest.
   All later ones of the rank are repeats, with all their strings at once.
3. *Long ties.*  Where a bucket has several ranks, strings of different ranks
   may still be equal.  Only the earliest suffix of each rank goes on: its
   strings are sorted anew in narrower buckets (``STEP`` neighbouring starts,
   which share the LENGTH - STEP + 1 bytes in their middle), and what is still
   open there string by string.

Ranks, buckets and strings are 64-bit hashes of their bytes (a wrong match
needs two equal hashes inside one bucket).  Counts and earliest places are
combined before the shuffle and hot buckets meet their rows in joins that
Spark splits; a task never holds a bucket, only a run of texts.  Each level is
a written table.

Defined results: a null text is empty; rows that repeat an id with one text are
one document; of rows with one id and different texts each has a place of its
own (in the order of a hash); a document with a null id loses what it repeats
of itself and makes no other a repeat, nor is it one's; an empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm import textbatch as tb
from sitelens.llm.common import clean, mapped, materialize, several_texts, spread, told_apart

#: Bytes of a string, of a bucket's common prefix, and starts that a narrower bucket has.
LENGTH, WORD, STEP = 100, 24, 16
#: Bytes of text whose suffixes are handled at once, about.
RUN = 1 << 18
#: A place in 64 bits: the sampled suffix' start, and 7 bits each for how many bytes
#: before it the first and the last string start that reach it first.
AT = 14


#: A perfect difference cover: the powers of 2 modulo 73 (nine of them).
MODULUS = 73
RESIDUES = sorted({pow(2, i, MODULUS) for i in range(MODULUS)})


def covers(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, cover: str = "content") -> tuple[np.ndarray, ...]:
    """``row, at, low, high, prefix``: each sampled suffix' start and the first
    and last start of the strings that reach it; the prefix hashes."""
    prefix = tb.prefix_hash(data)
    words = length - WORD + 1
    if cover == "difference":
        sizes = np.diff(offsets)
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(row)) - offsets[row]
        some = np.flatnonzero(np.isin(place % MODULUS, RESIDUES) & (place + WORD <= sizes[row]) & (sizes[row] >= length))
        row, place = row[some], place[some]
        low, high = np.maximum(place - MODULUS + 1, 0), np.minimum(place, sizes[row] - length)
        some = low <= high
        row, place, low, high = row[some], place[some], low[some], high[some]
        return row, place + offsets[row], low + offsets[row], high + offsets[row], prefix
    n = len(data) - length + 1
    if n <= 0:
        return (*[np.zeros(0, np.int64)] * 4, prefix)
    start = np.arange(len(data) - WORD + 1)
    low = (tb.span_hash(prefix, start, start + WORD) & tb.U64(0xFFFFFFFF00000000)) | start.astype(np.uint64)
    width = 1
    while width < words:  # smallest of 2, 4, 8 ... neighbours
        step = min(width, words - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    at = (low & tb.U64(0xFFFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.maximum(np.diff(offsets) - length + 1, 0))
    starts = np.arange(len(row)) + (offsets[:-1] - np.append(0, np.cumsum(np.maximum(np.diff(offsets) - length + 1, 0)))[:-1])[row]
    at = at[starts]
    if not len(at):
        return (*[np.zeros(0, np.int64)] * 4, prefix)
    new = np.append(True, (at[1:] != at[:-1]) | (row[1:] != row[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return row[first], at[first], starts[first], starts[last], prefix


def _rank(prefix: np.ndarray, at: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """By the bytes of [start, end) and where in them the sampled suffix starts."""
    return tb.mix(tb.span_hash(prefix, start, end) + (at - start).astype(np.uint64) * tb.PLACE[50])


def _packed(at: np.ndarray, back_low: np.ndarray, back_high: np.ndarray) -> np.ndarray:
    return at << AT | back_low << 7 | back_high


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of the sampled suffix, and how far before it the first and the last string start."""
    return place >> AT, place >> 7 & 127, place & 127


def _suffixes(tagged: DataFrame, length: int, cover: str) -> DataFrame:
    """``bucket, rank, id_, tag_, place`` of every sampled suffix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, data, offsets in tb.text_chunks(b.column(2), RUN):
                row, at, low, high, prefix = covers(data, offsets, length, cover)
                place, whose = _packed(at - offsets[row], at - low, at - high), pa.array(first + row)
                yield pa.RecordBatch.from_arrays(
                    [tb.as_longs(tb.span_hash(prefix, at, at + WORD)), tb.as_longs(_rank(prefix, at, low, high + length)), b.column(0).take(whose), b.column(1).take(whose), pa.array(place)],
                    ["bucket", "rank", "id_", "tag_", "place"])

    given = tagged.where("id_ is not null").select("id_", "tag_", "text_")
    return mapped(given, run, f"bucket long, rank long, id_ {given.schema['id_'].dataType.simpleString()}, tag_ long, place long")


def _narrowed(tagged: DataFrame, open_: DataFrame, length: int, step: int) -> DataFrame:
    """The open places' strings as suffixes of narrower buckets, of ``step`` starts each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            asked = b.column(3)
            sizes = np.diff(asked.offsets.to_numpy())
            begin = np.append(0, np.cumsum(sizes))
            places = asked.flatten().to_numpy()
            for first, data, offsets in tb.text_chunks(b.column(2), RUN):
                n = len(offsets) - 1
                row = np.repeat(np.arange(n), sizes[first : first + n])
                at, back_low, back_high = _unpacked(places[begin[first] : begin[first + n]])
                prefix = tb.prefix_hash(data)
                for j in range((length - WORD) // step + 1):
                    some = (back_high < (j + 1) * step) & (back_low >= j * step)
                    far, near = np.minimum(back_low[some], (j + 1) * step - 1), np.maximum(back_high[some], j * step)
                    r = row[some]
                    x = at[some] + offsets[r]
                    middle = tb.span_hash(prefix, x - j * step, x - (j + 1) * step + 1 + length)
                    yield pa.RecordBatch.from_arrays(
                        [tb.as_longs(tb.mix(middle + tb.U64(j))), tb.as_longs(_rank(prefix, x, x - far, x - near + length)),
                         b.column(0).take(pa.array(first + r)), b.column(1).take(pa.array(first + r)), pa.array(_packed(at[some], far, near))], ["bucket", "rank", "id_", "tag_", "place"])

    asks = open_.groupBy("id_", "tag_").agg(F.collect_set("place").alias("places"))
    given = tagged.join(asks, ["id_", "tag_"]).select("id_", "tag_", "text_", "places")
    return mapped(given, run, f"bucket long, rank long, id_ {given.schema['id_'].dataType.simpleString()}, tag_ long, place long")


def _sorted_out(suffixes: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``id_, tag_, place`` of the repeats, and of the earliest suffix of each rank in buckets of several ranks."""
    spark = suffixes.sparkSession
    # written, so that the join sees two shuffled sides and can split a hot bucket
    several, _ = materialize(suffixes.groupBy("bucket").count().where("count > 1").select("bucket"), f"{name}several")
    tied, _ = materialize(suffixes.join(several, "bucket", "left_semi"), f"{name}tied")
    clean(spark)
    here = F.struct("id_", "tag_", "place")
    firsts, _ = materialize(tied.groupBy("bucket", "rank").agg(F.min(here).alias("first"), F.count(F.lit(1)).alias("n")), f"{name}ranks")
    mixed, _ = materialize(firsts.groupBy("bucket").count().where("count > 1").select("bucket"), f"{name}mixed")
    open_, _ = materialize(firsts.join(mixed, "bucket", "left_semi").select("first.id_", "first.tag_", "first.place"), f"{name}open")
    repeats, _ = materialize(tied.join(firsts.where("n > 1").select("bucket", "rank", "first"), ["bucket", "rank"])
                             .where(F.col("first") < here).select("id_", "tag_", "place"), f"{name}repeats")
    clean(spark)
    return repeats, open_


def _own(raw: bytes, length: int) -> np.ndarray:
    """Starts of the strings of a text that start earlier in it too."""
    start = np.arange(max(0, len(raw) - length + 1))
    found = tb.span_hash(tb.prefix_hash(np.frombuffer(raw, np.uint8)), start, start + length)
    order = np.argsort(found, kind="stable")
    return order[1:][found[order[1:]] == found[order[:-1]]]


def deduplicated(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", cover: str = "content") -> DataFrame:
    """``id_col, kept`` (bytes), ``spans`` (removed byte ranges start, end, in order) and ``n_bytes`` of every row."""
    if not WORD < length <= WORD + 127:
        raise ValueError(f"length must be over {WORD} and at most {WORD + 127}")
    if cover != "content" and (cover != "difference" or length < WORD + MODULUS - 1):
        raise ValueError(f"cover must be content, or difference with a length of at least {WORD + MODULUS - 1}")
    spark = docs.sparkSession
    several = several_texts(docs, id_col, text_col)
    tagged = told_apart(docs, several, id_col, text_col)
    repeats, open_ = _sorted_out(_suffixes(told_apart(spread(docs), several, id_col, text_col), length, cover), "suffix")
    for step in (STEP, 1):
        narrow, n = materialize(_narrowed(tagged, open_, length, step), f"step{step}")
        clean(spark)
        if not n:
            break
        more, open_ = _sorted_out(narrow, f"step{step}")
        repeats = repeats.union(more)
    marks = repeats.groupBy("id_", "tag_").agg(F.collect_list("place").alias("places"))
    given = tagged.join(marks, ["id_", "tag_"], "left").select("id_", "text_", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, 256):
                b = whole.slice(s, 256)
                kept, spans, sizes = [], [], []
                for key, text, places in zip(b.column(0), b.column(1), b.column(2), strict=True):
                    raw = (text.as_py() or "").encode()
                    sizes.append(len(raw))
                    edges: np.ndarray = np.zeros(0, np.int64)
                    if places.is_valid or not key.is_valid:
                        if key.is_valid:
                            at, far, near = _unpacked(places.values.to_numpy())
                        else:
                            at = _own(raw, length)
                            far = near = np.zeros(len(at), np.int64)
                        depth = np.bincount(at - far, minlength=len(raw) + 1) - np.bincount(at - near + length, minlength=len(raw) + 1)
                        covered = np.cumsum(depth) > 0
                        edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0))
                    bounds = [0, *edges.tolist(), len(raw)]
                    kept.append(b"".join(raw[i:j] for i, j in zip(bounds[::2], bounds[1::2], strict=True)))
                    spans.append([{"start": i, "end": j} for i, j in zip(bounds[1:-1:2], bounds[2::2], strict=True)])
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept, pa.binary()), pa.array(spans, kind), pa.array(sizes, pa.int64())], ["id_", "kept", "spans", "n_bytes"])

    kind = given.schema["id_"].dataType.simpleString()
    return mapped(given, run, f"id_ {kind}, kept binary, spans array<struct<start: long, end: long>>, n_bytes long").withColumnRenamed("id_", id_col)

