"""Document fingerprints from closed syncmers.

Of all ``K`` code points in a row, those are anchors whose smallest inner
string of ``S`` code points (by a hash) is the first or the last: whether a
k-mer is an anchor depends on it alone, not on its surroundings, so texts that
share a passage share its anchors whatever stands around it.  A fingerprint
keeps all anchors whose hash is below ``SHARE``, so it grows with the text and
texts that share a passage keep the same anchors of it; where these are fewer
than ``KEPT``, it keeps so many with the smallest hashes.  Each has its first
place (code points from the text's start); they are in order of place: 16
hexadecimal digits an anchor (hash, then place).

``likeness`` matches positions: anchors common to both fingerprints (up to the
hash that both cover) are chained in increasing order of both places; it is
twice the longest chain's length over the number of anchors compared (0 to 1).

``edited`` sets each text beside the next one in descending order of id: ids
are cut into ranges, each range is one sorted partition, and the first text of
a range is copied to the end of the one before, so texts are shuffled once and
no window spans the table.

Defined results: a null text is empty and has the empty fingerprint; a text
without anchors (shorter than K, or by chance) has one made of the whole text;
two empty fingerprints have likeness 1, one empty 0; equal ids are ordered by a
hash of their texts; null ids come last; one row alone is its own next; an
empty table gives an empty result.  Columns beyond the named ones are not
read."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.llm import textbatch as tb
from sitelens.llm.common import mapped, slots, spread

K, S = 12, 6
#: Anchors of a fingerprint, at least, where a text has so many.
KEPT = 64
#: Anchors with a hash below this, an eighth of all, are kept whatever the text.
SHARE = 1 << 29
#: Code points that are fingerprinted at once, about.
RUN = 1 << 19


def anchors(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """``hash, place`` of all anchors of each text, in order of place."""
    ends = np.cumsum([len(t) for t in texts])
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    code = tb.mix(code.astype(np.uint64) + tb.PLACE[11])
    n = len(code)
    m = max(0, n - S + 1)
    inner = np.zeros(m, np.uint64)
    for j in range(S):
        inner += code[j : m + j] * tb.PLACE[30 + j]
    inner = tb.mix(inner)
    m = max(0, n - K + 1)
    low = inner[:m].copy()
    for j in range(1, K - S + 1):
        np.minimum(low, inner[j : m + j], out=low)
    place = np.flatnonzero((low == inner[:m]) | (low == inner[K - S : m + K - S]))
    whole = tb.mix(inner[place] * tb.PLACE[40] + inner[place + S] * tb.PLACE[41]) >> tb.U64(32) if K == 2 * S else None
    out, begin = [], 0
    first = np.searchsorted(place, np.append(0, ends))
    for text, i, j, end in zip(texts, first[:-1], first[1:], ends.tolist(), strict=True):
        j = i + np.searchsorted(place[i:j], end - K, "right") if end - begin >= K else i
        if j > i:
            out.append((whole[i:j].astype(np.uint32), (place[i:j] - begin).astype(np.uint32)))
        else:
            one = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=4).digest()
            out.append((np.frombuffer(one, "<u4")[: len(text) and 1], np.zeros(len(text) and 1, np.uint32)))
        begin = end
    return out


def _kept(found: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, int]]:
    key, first = np.unique(found[0], return_index=True)
    n = max(KEPT, int(np.searchsorted(key, SHARE)))
    key, place = key[:n], found[1][first[:n]]
    order = np.argsort(place, kind="stable")
    return list(zip(key[order].tolist(), place[order].tolist(), strict=True))


def fingerprints(texts: list[str]) -> list[list[tuple[int, int]]]:
    return [_kept(x) for x in anchors(texts)]


def shown(fingerprint: list[tuple[int, int]]) -> str:
    return np.array(fingerprint, ">u4").tobytes().hex()


def likeness(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> float:
    if not a or not b:
        return float(a == b)
    cover = min(max(SHARE - 1, *(h for h, _ in x)) if len(x) >= KEPT else 1 << 32 for x in (a, b))
    there = {h: p for h, p in b if h <= cover}
    ours = [h for h, _ in a if h <= cover]
    ends: list[int] = []  # the smallest last place of a chain of each length
    for h in ours:
        if (p := there.get(h)) is not None:
            at = bisect_left(ends, p)
            ends[at : at + 1] = [p]
    return 2 * len(ends) / max(1, len(ours) + len(there))


def fingerprinted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fingerprint`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows in _runs((x or "" for x in b.column(1).to_pylist())):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(rows[0], len(rows[1])), pa.array([shown(f) for f in fingerprints(rows[1])])], ["id_", "fingerprint"])

    given = spread(docs).select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"))
    return mapped(given, run, f"id_ {given.schema[0].dataType.simpleString()}, fingerprint string").withColumnRenamed("id_", id_col)


def _runs(texts: Iterator[str]) -> Iterator[tuple[int, list[str]]]:
    at, run, size = 0, [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= RUN:
            yield at, run
            at, run, size = at + len(run), [], 0
    if run:
        yield at, run


def _above(splits: list[float], col: str) -> Column:
    """How many of the ascending splits are over the column: by groups of
    about sqrt(n) splits, then inside one group, so a row tests few of them."""
    if not splits:
        return F.lit(0)
    step = isqrt(len(splits) - 1) + 1
    groups = [splits[i : i + step] for i in range(0, len(splits), step)]
    over = lambda values: F.size(F.filter(values.cast("array<double>"), lambda s: s > F.col(col)))
    whole = over(F.lit([g[0] for g in groups]))  # groups that are over it from their first split on: the last ones
    first = F.lit(len(groups)) - whole
    rest = F.greatest(F.lit(len(splits)) - first * step, F.lit(0))
    return rest + F.when(first > 0, over(F.element_at(F.array(*[F.lit(g) for g in groups]), first))).otherwise(0)


def _neighbours(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``part, extra, id_, text_`` sorted in partitions of one range of ids
    each, descending; the last row of a partition is the next one's first."""
    parts = 2 * slots(docs.sparkSession)
    splits = sorted(set(docs.stat.approxQuantile(id_col, [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 else []))
    given = docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"), F.xxhash64(text_col).alias("tie"), F.lit(False).alias("extra"))
    given = given.withColumn("part", F.when(F.col("id_").isNull(), len(splits)).otherwise(_above(splits, "id_")).cast("int"))
    heads = given.groupBy("part").agg(F.min(F.struct(F.col("id_").isNull().alias("none"), F.bitwise_not("id_").alias("down"), "tie")).alias("x"))
    heads = sorted((r["part"], r["x"]["down"], r["x"]["tie"]) for r in heads.collect())  # one row a partition
    if not heads:
        return given.select("part", "extra", "id_", "text_")
    to = [(~d if d is not None else None, t, heads[i - 1][0]) for i, (_, d, t) in enumerate(heads)]  # the first range's head follows the last
    copies = docs.sparkSession.createDataFrame(to, "head long, head_tie long, to int")
    extra = (given.join(F.broadcast(copies), F.col("id_").eqNullSafe(F.col("head")) & (F.col("tie") == F.col("head_tie")))
             .dropDuplicates(["to"]).select("id_", "text_", "tie", F.lit(True).alias("extra"), F.col("to").alias("part")))
    return (given.unionByName(extra).repartitionById(len(splits) + 1, F.col("part"))
            .sortWithinPartitions("extra", F.col("id_").desc_nulls_last(), "tie").select("part", "extra", "id_", "text_"))


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` of every row: its text, its text with the last
    third replaced by as much of the next one's beginning, and the next text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for b in batches:
            for key, text in zip(b.column(2), b.column(3), strict=True):
                ids.append(key)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= RUN and len(texts) > 1:
                    yield made(ids, texts)
                    ids, texts = ids[-1:], texts[-1:]
                    size = len(texts[0])
        if len(texts) > 1:
            yield made(ids, texts)

    def made(ids: list, texts: list[str]) -> pa.RecordBatch:
        """All rows but the last, which is the next of the one before."""
        changed = [t[: len(t) - len(t) // 3] + after[: len(t) // 3] for t, after in zip(texts, texts[1:], strict=False)]
        own, other = fingerprints(texts), fingerprints(changed)
        n = len(changed)
        return pa.RecordBatch.from_arrays([
            pa.array([x.as_py() for x in ids[:n]], pa.int64()), pa.array([len(t) for t in texts[:n]], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
            pa.array([shown(f) for f in own[:n]]), pa.array([shown(f) for f in other]),
            pa.array([likeness(a, b) for a, b in zip(own, other, strict=False)]), pa.array([likeness(a, b) for a, b in zip(own, own[1:], strict=False)])],
            ["id_", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    out = mapped(_neighbours(docs.withColumn(id_col, F.col(id_col).cast("long")), id_col, text_col), run,
                 "id_ long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return out.withColumnRenamed("id_", id_col)
