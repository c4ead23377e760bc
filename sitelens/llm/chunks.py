"""Substring dedup by content-defined chunking with a gear rolling hash.

A text's UTF-8 bytes are cut after every byte at which the gear hash
(h = 2 h + GEAR[byte] modulo 2**16, so of the last 16 bytes alone) is below
2**16 / ``AVERAGE``.  Cuts depend on nearby bytes only, so an insertion shifts
no chunk beyond it.  A chunk is a copy when its digest occurs earlier: in a
smaller id, or earlier in the same text.  A run of neighbouring copies is
removed when it has at least ``min_run`` bytes; shorter runs are everyday
phrases and stay.  As a run has several chunks, 64-bit digests suffice: one
false match removes nothing.  Removal is judged on the input, not on what is
left; white space left on both sides of a cut stays.

Digests are pre-aggregated before the shuffle (smallest place and count), only
repeated ones meet the chunks again, in a join that Spark splits where a digest
is hot.  A document's own chunk starts are the only group that is gathered.

Defined results: a null text is kept and has no chunk, an empty one too; of
repeated rows (equal id and text) none is a copy of the other, as their places
are equal; rows of one id with different texts have places of their own, in the
order of a hash of the text; a document with a null id has no place among the others: it loses
what it repeats of itself and makes no other a copy; an empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm import textbatch as tb
from sitelens.llm.common import mapped, several_texts, spread, told_apart

#: Bytes of a chunk, on average, and of the gear hash's window.
AVERAGE, WINDOW = 32, 16
#: Bytes that a removed run has at least.
MIN_RUN = 96
GEAR = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 16, 256, dtype=np.uint16)


def cuts(data: np.ndarray, offsets: np.ndarray, average: int = AVERAGE) -> np.ndarray:
    """Ends of all chunks of the rows; a row's end is one.  The first cut of a
    row comes after a whole window, which no byte of another row is in."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):  # sums over 2, 4, 8, 16 bytes; what is older has left the 16 bits
        h[step:] += h[:-step] << np.uint16(step)
    low = np.flatnonzero(h < (1 << 16) // average) + 1
    row = np.searchsorted(offsets, low - 1, "right") - 1
    low = low[low - offsets[row] >= WINDOW]
    mark = np.zeros(len(data) + 1, bool)
    mark[low] = mark[offsets[1:]] = True
    mark[0] = False
    return np.flatnonzero(mark)


def chunks(tagged: DataFrame, average: int = AVERAGE) -> DataFrame:
    """``digest, id_, tag_, at`` of every chunk of :func:`told_apart` texts; ``at`` is its first byte's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, data, offsets in tb.text_chunks(b.column(1)):
                end = cuts(data, offsets, average)
                start = np.append(0, end[:-1])[: len(end)]
                row = np.searchsorted(offsets, start, "right") - 1
                digest = tb.exact_hash(data, start, end)
                whose = pa.array(first + row)
                yield pa.RecordBatch.from_arrays([tb.as_longs(digest), b.column(0).take(whose), b.column(2).take(whose), pa.array(start - offsets[row])], ["digest", "id_", "tag_", "at"])

    given = tagged.where("id_ is not null").select("id_", "text_", "tag_")
    return mapped(given, run, f"digest long, id_ {given.schema[0].dataType.simpleString()}, tag_ long, at long")


def copied(tagged: DataFrame, average: int = AVERAGE) -> DataFrame:
    """``id_, tag_, starts``: the first bytes of the chunks that are copies."""
    found = chunks(tagged, average)
    place = F.struct("id_", "tag_", "at")
    firsts = (found.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("digest", "first"))
    copies = found.join(firsts, "digest").where(F.col("first") < place)
    return copies.groupBy("id_", "tag_").agg(F.collect_set("at").alias("starts"))


def deduplicated(docs: DataFrame, average: int = AVERAGE, min_run: int = MIN_RUN, id_col: str = "doc_id", text_col: str = "text",
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the carried columns, the kept ``text_col`` and ``spans``, the
    removed byte ranges (start, end), of every row."""
    several = several_texts(docs, id_col, text_col)
    marks = copied(told_apart(spread(docs), several, id_col, text_col), average)
    met = told_apart(docs, several, id_col, text_col, carry).join(marks, ["id_", "tag_"], "left").select("id_", *[f"carry_{c}" for c in carry], "text_", "starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, starts = b.column(b.num_columns - 2), b.column(b.num_columns - 1)
            kept, spans = texts.to_pylist(), [[] for _ in range(len(texts))]
            for i, (key, marked) in enumerate(zip(b.column(0), starts, strict=True)):
                if not marked.is_valid and (key.is_valid or not kept[i]):
                    continue
                raw = kept[i].encode()
                data = np.frombuffer(raw, np.uint8)
                end = cuts(data, np.array([0, len(raw)]), average)
                size = dict(zip(np.append(0, end[:-1]).tolist(), end.tolist(), strict=True))
                runs: list[list[int]] = []
                for s in sorted(marked.as_py() if marked.is_valid else _own(data, end)):
                    if runs and runs[-1][1] == s:
                        runs[-1][1] = size[s]
                    else:
                        runs.append([s, size[s]])
                spans[i] = [_whole(raw, s, e) for s, e in runs if e - s >= min_run]
                bounds = [0, *[x for span in spans[i] for x in span], len(raw)]
                kept[i] = b"".join(raw[s:e] for s, e in zip(bounds[::2], bounds[1::2], strict=True)).decode()
            made = pa.array([[{"start": s, "end": e} for s, e in one] for one in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(kept, texts.type), made], [*b.schema.names[:-1], "spans"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in met.schema.fields[:-1]], "spans array<struct<start: long, end: long>>"])
    return mapped(met, run, schema).select(F.col("id_").alias(id_col), *[F.col(f"carry_{c}").alias(c) for c in carry], F.col("text_").alias(text_col), "spans")


def _own(data: np.ndarray, end: np.ndarray) -> list[int]:
    """Starts of the chunks of a text that it holds earlier too."""
    start = np.append(0, end[:-1])
    found = tb.exact_hash(data, start, end)
    order = np.argsort(found, kind="stable")
    return start[order[1:][found[order[1:]] == found[order[:-1]]]].tolist()


def _whole(raw: bytes, start: int, end: int) -> tuple[int, int]:
    """The span without the code points that it holds in part."""
    while start < end and raw[start] & 0xC0 == 0x80:
        start += 1
    while end > start and end < len(raw) and raw[end] & 0xC0 == 0x80:
        end -= 1
    return start, end
