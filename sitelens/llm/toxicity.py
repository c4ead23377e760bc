"""Toxicity: character n-gram linear classifier whose features are scaled by
naive Bayes log-count ratios, trained on labelled text.

Features are the 4-, 5- and 6-grams of code points (A-Z and the capitals of
Latin-1 in lower case), hashed to 2**BITS places and counted once a text.  A
place's ratio r is the log of its smoothed share among toxic texts over that
among the others.  Places whose share differs clearly between the classes are
kept; a logistic regression on r-scaled presence gives their weights, and a
score is the logistic function of the sum over the places present.

Defined results: a null text is empty; an empty text has the intercept's
score; repeated rows are scored each; with no labelled row every score is 0.5
and an empty table gives an empty result; a null id is never held out.  Other
columns of the input, whatever their names, are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.llm import classify as cl
from sitelens.llm import textbatch as tb
from sitelens.llm.common import mapped

SIZES = (4, 5, 6)
#: Bytes of text whose n-grams are made at once: about 100 bytes of arrays for each.
RUN = tb.CHUNK // 16
#: Counted places that are sent in one batch.
SENT = 1 << 16
#: Bits of a feature's place in the weight table.
BITS = 20
#: Standard errors by which a place's shares must differ, and texts it must be in.
CLEAR, SUPPORT = 3.0, 3
EPOCHS = 8
#: Code points whose lower case is 32 higher: A-Z, and the capitals of Latin-1 but for the sign x.
_CAPITAL = np.zeros(256, bool)
_CAPITAL[[*range(65, 91), *range(0xC0, 0xD7), *range(0xD8, 0xDF)]] = True


def grams(column: pa.Array) -> Iterator[tuple[int, int, list[tuple[np.ndarray, np.ndarray]]]]:
    """For each run of rows: first row, number of rows, and for each size the row (from 0) and place of every n-gram."""
    shift = tb.U64(64 - BITS)
    for at, data, offsets in tb.text_chunks(column, RUN):
        begins = (data & 0xC0) != 0x80
        chars = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        if len(chars) != begins.sum():  # not valid UTF-8: bytes stand for themselves
            chars, begins = data.astype(np.uint32), np.ones(len(data), bool)
        ends = np.concatenate([[0], np.cumsum(begins)])[offsets]
        chars = chars + np.where(chars < 256, _CAPITAL[np.minimum(chars, 255)], False).astype(np.uint32) * np.uint32(32)
        code = tb.mix(chars.astype(np.uint64) + tb.PLACE[10])
        row = np.repeat(np.arange(len(ends) - 1, dtype=np.int32), np.diff(ends))
        out, total, n = [], np.zeros(len(code), np.uint64), len(code)
        for size in range(1, SIZES[-1] + 1):
            m = max(0, n - size + 1)
            total = total[:m] + code[size - 1 :][:m] * tb.PLACE[size]
            if size in SIZES:
                inside = row[:m] == row[size - 1 :][:m]
                out.append((row[:m][inside], (tb.mix(total[inside]) >> shift).astype(np.int32)))
        yield at, len(ends) - 1, out


def _present(found: list[tuple[np.ndarray, np.ndarray]], keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``row, place`` of the places that ``keep`` marks, in order."""
    parts = []
    for row, place in found:
        hit = np.flatnonzero(keep[place])
        parts.append(row[hit].astype(np.int64) << BITS | place[hit])
    both = np.sort(np.concatenate(parts))
    both = both[np.append(True, both[1:] != both[:-1])] if len(both) else both
    return both >> BITS, both & ((1 << BITS) - 1)


def _ratios(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Each place's ratio and whether it is kept, from the numbers of texts (all,
    toxic) that hold it: counted by every task, added up by place; the kept ones
    (2**BITS short rows at most) come to the driver."""
    size = 1 << BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, seen, toxic = np.ones(size, bool), np.zeros(size, np.int64), np.zeros(size, np.int64)
        for b in batches:
            y = b.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
            for first, _, found in grams(b.column("text")):
                row, place = _present(found, every)
                np.add.at(seen, place, 1)
                np.add.at(toxic, place, y[first + row])
        places = np.flatnonzero(seen)
        for i in range(0, len(places), SENT):
            at = places[i : i + SENT]
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at]), pa.array(toxic[at])], ["at", "seen", "toxic"])

    rows, ones = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    n1, n0 = float(max(ones, 1)), float(max(rows - ones, 1))
    counts = mapped(sample.select("text", "label"), run, "at int, seen long, toxic long").groupBy("at").agg(*[F.sum(c).alias(c) for c in ("seen", "toxic")])
    both = F.col("seen") / F.lit(n1 + n0)
    apart = F.abs(F.col("toxic") / F.lit(n1) - (F.col("seen") - F.col("toxic")) / F.lit(n0)) / F.sqrt(F.greatest(both * (1 - both) * F.lit(1 / n1 + 1 / n0), F.lit(1e-12)))
    at, seen, toxic = (c.to_numpy() for c in counts.where((apart >= CLEAR) & (F.col("seen") >= SUPPORT)).toArrow().columns)
    ratio, keep = np.zeros(size), np.zeros(size, bool)
    ratio[at] = np.log((toxic + 0.5) / (n1 + 1)) - np.log((seen - toxic + 0.5) / (n0 + 1))
    keep[at] = True
    return ratio, keep


def _margins(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    out, keep = np.zeros(len(column)), weights != 0
    for first, count, found in grams(column):
        row, place = _present(found, keep)
        out[first : first + count] = np.bincount(row, weights[place], count)
    return out


def train(docs: DataFrame, labels: DataFrame, keep: Column, label: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text", bound: int = cl.MAX_LABELLED) -> tuple[np.ndarray, float]:
    """Weights and intercept from at most ``bound`` labelled rows; ``keep`` is a condition on the column ``id``."""
    sample = cl.labelled_sample(docs, labels, label, keep, id_col, text_col, bound)
    ratio, kept = _ratios(sample)
    sent = docs.sparkSession.sparkContext.broadcast(kept)

    def places(column: pa.Array) -> Iterator[list[pa.Array]]:
        for _, count, found in grams(column):
            row, place = _present(found, sent.value)
            cut = np.searchsorted(row, np.arange(count + 1)).astype(np.int32)
            yield [pa.ListArray.from_arrays(pa.array(cut), pa.array(place.astype(np.int32)))]

    rows = cl.featured(sample, places, {"at": "array<int>"})
    weights, bias = cl.fitted(rows, 1 << BITS, values=ratio.astype(np.float32), epochs=EPOCHS, alpha=0.1, beta=1.0, l1=0.05, l2=0.1)
    return weights * ratio, bias


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text",
          carried: dict[str, Column] | None = None) -> DataFrame:
    """``id_col`` (or the carried columns) and ``score`` of every row: the likelihood that its label is 1."""
    return cl.scored(docs, carried or {id_col: F.col(id_col)}, text_col, model, _margins)
