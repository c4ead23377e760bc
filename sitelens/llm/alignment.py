"""Cross-tokenizer alignment by inverted pair bitmaps.

A text is encoded by two tokenizers; the byte offsets at which tokens of both
end cut them into groups, and tokens of a group are linked, each of the one
with each of the other.  A pair of ids is held by a compressed bitmap of the
documents that hold it linked, one for each binary place of the number of its
links there (a multiplicity plane).

Documents are numbered in blocks of ``DOCS`` or of ``LINKED`` (pair, document)
entries, so a pair has one row a block however frequent it is, and a hot pair is
a small share of the rows.  The planes of a row are OR-merged and popcounted for
its documents, the planes' popcounts give its links; Spark adds them up by pair,
combined before the shuffle.  Rows then meet their pair's count and go back to
their block, where each posting gives its documents their scores.

Encoding works on pieces of text between certain cuts: a space after a character
that is not white space, where the first tokenizer's pattern always cuts, and
where the second's vocabulary has no piece that could join (checked; else a
text is one piece).  Pieces recur, so their groups are remembered in a bounded map.

Defined results: a text that is null or empty, or that one of the two does not
give back byte by byte, has no tokens: zeros and an empty digest.  Every row is
a document of its own, also where an id is repeated or null; an empty table
gives an empty result; columns beyond those named are not read."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.bpe import PLAIN
from sitelens.llm.common import mapped, materialize, scratch_path, ship, spread
from sitelens.llm.packing import encoder
from sitelens.llm.textbatch import as_longs

#: Documents of a block at most (places in its bitmaps), and entries from which it is closed.
DOCS, LINKED = 1 << 13, 1 << 20
#: Pieces of text, and links of such, that a worker remembers: some 150 MB.
PIECES, PIECE_LINKS = 1 << 19, 1 << 22
#: Characters of texts that are split at once, and of a piece that is short.
PART, SHORT = 1 << 20, 256
#: Pieces that are encoded at once.
JOINT = 1 << 12
#: Bits of an id, and of a document's place in its block: together with a second id 64.
ID_BITS, PLACE_BITS = 24, 16
#: Links of a group above which its equal tokens are counted before they are paired.
WIDE = 1 << 10

_CUT = re.compile(r"(?<=\S) ")
_ODD = re.compile(r"^\s|\s ")


class _Remembered:
    """Pieces of text with their tokens, groups and links under both tokenizers."""

    def __init__(self, first: str, second: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(first)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=second)
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = iter(range(256, 512))
        byte_of = {chr(b) if b in shown else chr(next(rest)): b for b in range(256)}
        self.a_bytes = {i: bytes(map(byte_of.__getitem__, t)) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if max(max(self.a_bytes), len(pieces)) >> ID_BITS:
            raise ValueError("ids of over 24 bits")
        self.quick = encoder(first)
        self.cuts = len(self.b.encode("a")) == 1 and not any(re.search("[^▁]▁", p) for p in pieces)
        self.a_size = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_size[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_size = np.array([len(x) for x in self.b_bytes])
        self.a_text, self.b_text = ({i: str(i) for i in self.a_bytes}, [str(i) for i in range(len(pieces))])
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.text: list[bytes | None] = []  # groups in decimal; None where a tokenizer does not give the bytes back
        self.sizes = np.zeros((4, 0), np.int64)  # tokens of a, of b, groups, links
        self.at = np.zeros(1, np.int64)
        self.pair, self.times = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def split(self, text: str) -> list[str]:
        """The pieces of space + text, each without the space that it begins with."""
        if not self.cuts:
            return [text]
        return _CUT.split(text) if _ODD.search(text) else text.split(" ")

    def places(self, pieces: list[str]) -> np.ndarray:
        if len(self.place) > PIECES or len(self.pair) > PIECE_LINKS:
            self.clear()
        new = [p for p in dict.fromkeys(pieces) if p not in self.place]
        if new:
            self._add(new)
        return np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))

    def _one_by_one(self, whole: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Both tokenizers' ids and their numbers by piece, and which pieces both give back."""
        a = [e.ids for e in self.a.encode_batch_fast(whole, add_special_tokens=False)]
        b = self.b.encode(["a" + w for w in whole] if self.cuts else [w[1:] for w in whole], num_threads=1)
        b = [ids[1:] for ids in b] if self.cuts else b
        given = [w.encode() for w in whole]
        sound = np.array([b"".join([self.a_bytes[i] for i in x]) == g and b"".join([self.b_bytes[i] for i in y]) == g for g, x, y in zip(given, a, b, strict=True)], bool)
        a, b = ([x if ok else [] for x, ok in zip(ids, sound, strict=True)] for ids in (a, b))
        return ([np.fromiter(chain.from_iterable(ids), np.int64) for ids in (a, b)], [np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (a, b)], sound)

    def _at_once(self, whole: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """As :meth:`_one_by_one`, of pieces between certain cuts: joined, encoded and cut again."""
        joined = "".join(whole)
        given = joined.encode()
        end = np.cumsum([len(w.encode()) for w in whole])
        flat, n = [], []
        for ids, table, size in ((self.quick(joined), self.a_bytes, self.a_size), (np.array(self.b.encode("a" + joined)[1:], np.int64), self.b_bytes, self.b_size)):
            ids = ids.astype(np.int64)
            at = np.cumsum(size[ids])
            if b"".join(map(table.__getitem__, ids.tolist())) != given:
                return self._one_by_one(whole)
            flat.append(ids)
            n.append(np.diff(np.append(0, np.searchsorted(at, end, "right"))))
        return flat, n, np.ones(len(whole), bool)

    def _add(self, new: list[str]) -> None:
        # pieces of common characters that end with a word stay apart when joined; tiktoken is quicker on them and gives the same
        apart = [self.cuts and 0 < len(p) <= SHORT and not p[-1].isspace() and PLAIN.fullmatch(p) is not None for p in new]
        joint, rest = ([p for p, x in zip(new, apart, strict=True) if x == y] for y in (True, False))
        new = joint + rest
        some = [self._at_once([" " + p for p in joint[i : i + JOINT]]) for i in range(0, len(joint), JOINT)]
        if rest:
            some.append(self._one_by_one([" " + p for p in rest]))
        (flat_a, flat_b), (n_a, n_b) = ([np.concatenate([x[k][side] for x in some]) for side in (0, 1)] for k in (0, 1))
        sound = np.concatenate([x[2] for x in some])
        list_a, list_b = flat_a.tolist(), flat_b.tolist()
        end_a, end_b = np.cumsum(self.a_size[flat_a]), np.cumsum(self.b_size[flat_b])
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        # the first token of each group, and the first group of each piece
        from_a, from_b = (np.append(0, np.searchsorted(end, common, "right")) for end in (end_a, end_b))
        done = np.append(0, np.cumsum(n_a))
        first = np.searchsorted(common, np.append(0, end_a)[done], "right")
        links = np.diff(from_a) * np.diff(from_b)
        text_a, text_b = (list(map(names.__getitem__, ids)) for names, ids in ((self.a_text, list_a), (self.b_text, list_b)))
        parts = [text_a[s] + "|" + text_b[u] if one == 1 else ",".join(text_a[s:e]) + "|" + ",".join(text_b[u:v])
                 for one, s, e, u, v in zip(links.tolist(), from_a[:-1].tolist(), from_a[1:].tolist(), from_b[:-1].tolist(), from_b[1:].tolist(), strict=True)]
        group, pair, times = self._pairs(flat_a, flat_b, from_a, from_b, links)
        at = np.searchsorted(group, first)  # pairs are in the order of their groups
        base, known = len(self.text), len(self.pair)
        bounds = first.tolist()
        self.text += [";".join(parts[s:e]).encode() if ok else None for ok, s, e in zip(sound.tolist(), bounds, bounds[1:], strict=False)]
        total = np.append(0, np.cumsum(links))
        self.sizes = np.concatenate([self.sizes, np.stack([n_a, n_b, np.diff(first), np.diff(total[first])])], axis=1)
        self.at = np.concatenate([self.at, known + at[1:]])
        self.pair, self.times = np.concatenate([self.pair, pair]), np.concatenate([self.times, times])
        self.place.update(zip(new, range(base, base + len(new)), strict=True))

    @staticmethod
    def _pairs(a: np.ndarray, b: np.ndarray, from_a: np.ndarray, from_b: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``group, pair, times`` of all links, in the order of the groups."""
        few = np.where(links <= WIDE, links, 0)
        group = np.repeat(np.arange(len(links)), few)
        k = np.arange(len(group)) - np.repeat(np.cumsum(few) - few, few)
        wide_b = np.diff(from_b)[group]
        pair = a[from_a[group] + k // wide_b].astype(np.uint64) << np.uint64(ID_BITS) | b[from_b[group] + k % wide_b].astype(np.uint64)
        times = np.ones(len(pair), np.int64)
        rest = np.flatnonzero(links > WIDE)
        if len(rest):
            more = []
            for g in rest:
                x, n = np.unique(a[from_a[g] : from_a[g + 1]], return_counts=True)
                y, m = np.unique(b[from_b[g] : from_b[g + 1]], return_counts=True)
                p = (x.astype(np.uint64)[:, None] << np.uint64(ID_BITS) | y.astype(np.uint64)).ravel()
                more.append((np.full(len(p), g), p, np.outer(n, m).ravel()))
            group, pair, times = (np.concatenate([old, *new]) for old, new in zip((group, pair, times), zip(*more, strict=True), strict=True))
            order = np.argsort(group, kind="stable")
            group, pair, times = group[order], pair[order], times[order]
        return group, pair, times


@lru_cache(maxsize=1)
def _remembered(first: str, second: str) -> _Remembered:
    return _Remembered(first, second)


def bitmaps(size: np.ndarray, places: np.ndarray, docs: int = DOCS) -> pa.Array:
    """Compressed bitmaps of consecutive runs of ascending places: 16 bits a
    place (an even length), or, where that is shorter, a bit a place and a last byte (odd)."""
    bits = -(-docs // 16) * 2
    dense = 2 * size > bits
    length = np.where(dense, bits + 1, 2 * size)
    offset = np.append(0, np.cumsum(length))
    out = np.zeros(offset[-1], np.uint8)
    of = np.repeat(np.arange(len(size)), size)
    rank = np.arange(len(places)) - np.repeat(np.cumsum(size) - size, size)
    thin = ~dense[of]
    at = offset[of[thin]] + 2 * rank[thin]
    out[at], out[at + 1] = places[thin] & 255, places[thin] >> 8
    full = places[~thin]
    np.bitwise_or.at(out, offset[of[~thin]] + (full >> 3), (1 << (full & 7)).astype(np.uint8))
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offset.astype(np.int32)), pa.py_buffer(out)])


def places(maps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``map, place`` of all places that the maps hold."""
    maps = maps.cast(pa.large_binary())
    _, where, raw = maps.buffers()
    offset = np.frombuffer(where, np.int64, len(maps) + 1, maps.offset * 8)
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    length = np.diff(offset)
    thin = np.flatnonzero(length % 2 == 0)
    n = length[thin] // 2
    of = np.repeat(thin, n)
    at = offset[of] + 2 * (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n))
    place = data[at].astype(np.int64) | data[at + 1].astype(np.int64) << 8
    full = np.flatnonzero(length % 2)
    if len(full):
        every = [np.flatnonzero(np.unpackbits(data[offset[i] : offset[i + 1] - 1], bitorder="little")) for i in full]
        of = np.concatenate([of, np.repeat(full, [len(x) for x in every])])
        place = np.concatenate([place, *every])
    return of, place


class _Block:
    """Documents and (pair, document) entries of a task, until they are a block."""

    def __init__(self, number: int):
        self.number, self.docs, self.keys, self.times, self.held = number, [], [], [], 0

    def add(self, key: np.ndarray, times: np.ndarray) -> None:
        self.keys.append(key)
        self.times.append(times)
        self.held += len(key)

    def rows(self, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        """The documents' rows, then a row of planes for each pair."""
        n = len(self.docs)
        yield _rows({"kind": np.zeros(n, np.int32), "block": np.full(n, self.number), "place": np.arange(n, dtype=np.int32)}, n, kind, self.docs)
        key, times = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (self.keys, self.times))
        if not len(key):
            return
        order = np.argsort(key)
        key, times = key[order], times[order]
        pair, place = key >> np.uint64(PLACE_BITS), (key & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        start = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        most = np.maximum.reduceat(times, start)
        planes = np.floor(np.log2(most)).astype(np.int64) + 1
        base = np.append(0, np.cumsum(planes))
        row = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(key))))
        set_in = [np.flatnonzero(times >> p & 1) for p in range(int(planes.max()))]
        entry, plane = np.concatenate(set_in), np.repeat(np.arange(len(set_in)), [len(x) for x in set_in])
        of = base[row[entry]] + plane
        order = np.argsort(of, kind="stable")  # each plane's entries are in the order of pairs and places
        maps = bitmaps(np.bincount(of, minlength=base[-1]), place[entry[order]])
        m = len(start)
        held = pa.ListArray.from_arrays(pa.array(base.astype(np.int32)), maps)
        yield _rows({"kind": np.ones(m, np.int32), "block": np.full(m, self.number), "pair": pair[start].view(np.int64), "planes": held}, m, kind)


#: Columns of the two kinds of rows that encoding writes.
_COLUMNS = {"kind": pa.int32(), "block": pa.int64(), "place": pa.int32(), "doc": None, "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(),
            "n_links": pa.int64(), "groups_sha256": pa.string(), "pair": pa.int64(), "planes": pa.list_(pa.binary())}
_OF_DOCS = ("doc", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def _rows(given: dict, n: int, kind: pa.DataType, docs: list[tuple] | None = None) -> pa.RecordBatch:
    types = {c: t or kind for c, t in _COLUMNS.items()}
    if docs:
        given = given | {c: pa.array(v, types[c]) for c, v in zip(_OF_DOCS, zip(*docs, strict=True), strict=True)}
    return pa.RecordBatch.from_arrays([given[c] if isinstance(given.get(c), pa.Array) else pa.array(given[c], t) if c in given else pa.nulls(n, t) for c, t in types.items()], list(types))


def _coded(first: str, second: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _remembered(first, second)
    number, block = TaskContext.get().partitionId() << 32, None
    for batch in batches:
        kind, keys, texts = batch.schema.field(0).type, batch.column(0), batch.column(1)
        at = 0
        while at < batch.num_rows:
            block = block or _Block(number)
            room, size, end, pieces = DOCS - len(block.docs), 0, at, []
            while end < batch.num_rows and end - at < room and size < PART:
                text = texts[end].as_py()
                pieces.append(known.split(text) if text else [])
                size += len(text or "")
                end += 1
            _part(known, block, keys[at:end].to_pylist(), pieces)
            at = end
            if len(block.docs) >= DOCS or block.held >= LINKED:
                yield from block.rows(kind)
                number, block = number + 1, None
    if block:
        yield from block.rows(kind)


def _part(known: _Remembered, block: _Block, keys: list, pieces: list[list[str]]) -> None:
    """Add documents to a block."""
    n = np.fromiter(map(len, pieces), np.int64, len(pieces))
    place = known.places(list(chain.from_iterable(pieces)))
    cut = np.append(0, np.cumsum(n)).tolist()
    base = len(block.docs)
    of, sound = np.repeat(np.arange(len(n)), n), np.ones(len(n), bool)
    flat = place.tolist()
    for i, key in enumerate(keys):
        mine = flat[cut[i] : cut[i + 1]]
        text = [known.text[p] for p in mine]
        sound[i] = bool(mine) and None not in text
        if sound[i]:
            block.docs.append((key, *known.sizes[:, place[cut[i] : cut[i + 1]]].sum(axis=1).tolist(), hashlib.sha256(b";".join(text)).hexdigest()))
        else:
            block.docs.append((key, 0, 0, 0, 0, ""))
    keep = sound[of]
    met, times = np.unique((base + of[keep]) << 40 | place[keep], return_counts=True)
    doc, piece = met >> 40, met & ((1 << 40) - 1)
    n = known.at[piece + 1] - known.at[piece]
    link = np.repeat(known.at[piece], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    key = known.pair[link] << np.uint64(PLACE_BITS) | np.repeat(doc, n).astype(np.uint64)
    times = known.times[link] * np.repeat(times, n)
    if len(key):
        order = np.argsort(key)
        key, times = key[order], times[order]
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        block.add(key[start], np.add.reduceat(times, start))


def encoded(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two written tables: ``block, place, doc, n_a, n_b, n_groups, n_links,
    groups_sha256`` of each document, and the inverted ``pair, block, planes``."""
    spark = docs.sparkSession
    given = spread(docs).select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    schema = (f"kind int, block long, place int, doc {given.schema[0].dataType.simpleString()}, n_a long, n_b long, n_groups long, n_links long,"
              " groups_sha256 string, pair long, planes array<binary>")
    path = scratch_path(spark, "aligned")
    mapped(given, lambda batches: _coded(first, second, batches), schema).write.partitionBy("kind").parquet(path)
    table = spark.read.schema(schema)
    return table.parquet(path).where("kind = 0").select("block", "place", *_OF_DOCS), table.parquet(path).where("kind = 1").select("pair", "block", "planes")


def pair_counts(index: DataFrame) -> DataFrame:
    """``pair, docs, links`` of every pair: documents by the OR of its planes, links by the planes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, place, worth = _entries(b.column(1))
            docs = np.bincount(np.unique(row << PLACE_BITS | place) >> PLACE_BITS, minlength=b.num_rows)
            links = np.zeros(b.num_rows, np.int64)
            np.add.at(links, row, worth)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(docs, pa.int64()), pa.array(links)], ["pair", "docs", "links"])

    rows = mapped(index.select("pair", "planes"), run, "pair long, docs long, links long")
    return rows.groupBy("pair").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))


def _entries(planes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, place, worth`` of every bit of the rows' planes."""
    if isinstance(planes, pa.ChunkedArray):
        planes = planes.combine_chunks()
    start = planes.offsets.to_numpy() - planes.offsets[0].as_py()
    of, place = places(planes.flatten())
    row = np.searchsorted(start, of, "right") - 1
    return row, place, np.int64(1) << (of - start[row])


def aligned(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    A pair's count is its number of documents; ``n_best`` counts a document's
    links whose count is their first id's highest, ``count_sum`` adds up the
    counts of its links."""
    texts, index = encoded(docs, first, second, id_col, text_col)
    counts, _ = materialize(pair_counts(index), "pairs")
    counts = counts.withColumn("a_", F.shiftright("pair", ID_BITS))
    most = counts.groupBy("a_").agg(F.max("docs").alias("most"))  # a row a token of the first vocabulary
    scored = counts.join(F.broadcast(most), "a_").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))
    postings = index.join(scored, "pair").select("block", "docs", "best", "planes")
    ship(docs.sparkSession)

    def run(mine: pa.Table, held: pa.Table) -> pa.Table:
        n = mine.num_rows
        place = mine.column("place").to_numpy()
        best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for b in held.combine_chunks().to_batches(max_chunksize=1 << 15):
            row, at, worth = _entries(b.column("planes"))
            np.add.at(best, at, worth * b.column("best").to_numpy(zero_copy_only=False)[row])
            np.add.at(total, at, worth * b.column("docs").to_numpy()[row])
        return mine.append_column("n_best", as_longs(best[place])).append_column("count_sum", as_longs(total[place])).drop_columns(["block", "place"])

    kind = texts.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    got = texts.groupBy("block").cogroup(postings.groupBy("block")).applyInArrow(run, schema)
    return got.select(F.col("doc").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
