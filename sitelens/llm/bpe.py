"""BPE encoding by forced boundaries, and decoding.

Two neighbouring units of a word (bytes, the last one marked as a word's end)
that are neighbours inside no token of the vocabulary can never be merged, nor
can a merge reach across them: the place between them is a certain cut.  A word
is split at all its certain cuts, each fragment is merged on its own, and the
fragments' ids are concatenated.  Words and fragments recur, so their ids are
remembered in bounded maps; a fragment is merged with a heap, so a word of any
length takes near-linear time.

The file is one of ``tokenizers``: lower case after composition, words by
classes of letters, digits and others, byte-level units with a word-end suffix.
Texts of common Latin characters are normalised here; others by the library's
own normaliser and word splitter.  Strings of the file's added tokens are those
tokens, as the library's default is.

Defined results: a null or empty text, and one of white space alone, has no ids
and decodes to the empty text; rows are independent of each other, so repeated
rows, ties and null ids need no rule and every row comes back; an empty table
gives an empty result; columns beyond those named are not read.  A text is
worked on in parts of about ``PART`` characters that begin at white space, where
no word can continue."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import mapped, spread

#: Characters of a text that are worked on at once.
PART = 1 << 18
#: Entries that the maps of words and of fragments keep, and the longest key: about 120 MB a worker at most.
WORDS, FRAGMENTS, LONGEST = 1 << 19, 1 << 16, 48
#: Bytes of results that an Arrow batch holds, about.
BATCH = 8 << 20
#: Characters that composition leaves alone, whatever stands beside them, whose classes all versions of Unicode share
#: and whose lower case does not depend on their place.
PLAIN = regex.compile("[\x00-ɏ‐-‧‰-⁞€]*+")
WHITE = "\t-\r \x85\xa0"
_ANY_WHITE = regex.compile(r"\s")


class _Remembered(dict):
    """A map that makes what it lacks; it starts anew when it holds ``most`` entries."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        made = self.make(key)
        if len(key) <= LONGEST:
            if len(self) >= self.most:
                self.clear()
            self[key] = made
        return made


class Encoder:
    """Texts to ids and back by a file of ``tokenizers`` of the form named above."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        file = json.loads(Path(path).read_text(encoding="utf-8"))
        model, self.suffix = file["model"], file["model"]["end_of_word_suffix"]
        split, level = file["pre_tokenizer"]["pretokenizers"]
        plain = [n["type"] for n in file["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]
        added = file["added_tokens"]
        if not (plain and self.suffix and split["invert"] and split["behavior"] == "Removed" and level["type"] == "ByteLevel" and not level["add_prefix_space"]
                and file["decoder"] is None and file["post_processor"] is None and not any(model[k] for k in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges"))
                and not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))):
            raise ValueError(f"{path}: not a word-end byte-level BPE file")
        self.library = Tokenizer.from_file(path)
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", WHITE))
        self.ids: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in added}
        self.at_added = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if added else None
        self.token = {i: t for t, i in (self.ids | self.added).items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(a, b): r for r, (a, b) in enumerate(merges)}
        self.joined = {pair for t in self.ids for pair in self._pairs(t)}
        self.unit = self._units()
        self.fragment, self.word = _Remembered(self._merged, FRAGMENTS), _Remembered(self._word, WORDS)

    @staticmethod
    def _units() -> list[str]:
        """The character that byte-level BPE writes for each byte."""
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = iter(range(256, 512))
        return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]

    def _pairs(self, token: str) -> Iterator[tuple[str, str]]:
        units = list(token.removesuffix(self.suffix))
        if token.endswith(self.suffix) and units:
            units[-1] += self.suffix
        return zip(units, units[1:], strict=False)

    def _word(self, word: str) -> bytes:
        """Ids of a word: cut where no token joins its units, each fragment on its own."""
        units = [self.unit[b] for b in word.encode()]
        units[-1] += self.suffix
        cuts = [0, *[i + 1 for i, pair in enumerate(zip(units, units[1:], strict=False)) if pair not in self.joined], len(units)]
        return b"".join([self.fragment[tuple(units[a:b])] for a, b in zip(cuts, cuts[1:], strict=False)])

    def _merged(self, units: tuple[str, ...]) -> bytes:
        """Ids of a fragment: the lowest merge first, the leftmost of equals first."""
        part, left, right = list(units), list(range(-1, len(units) - 1)), [*range(1, len(units)), -1]
        waiting = [(r, i) for i in range(len(part) - 1) if (r := self.rank.get((part[i], part[i + 1]))) is not None]
        heapq.heapify(waiting)
        while waiting:
            r, i = heapq.heappop(waiting)
            j = right[i]
            if part[i] is None or j < 0 or self.rank.get((part[i], part[j])) != r:
                continue  # one of the two has been merged since
            part[i], part[j] = part[i] + part[j], None
            right[i] = right[j]
            if right[i] >= 0:
                left[right[i]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b >= 0 and (r := self.rank.get((part[a], part[b]))) is not None:
                    heapq.heappush(waiting, (r, a))
        return np.array([self.ids[p] for p in part if p is not None], "<u4").tobytes()

    def _parts(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > PART:
            cut = _ANY_WHITE.search(text, start + PART)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def _plain_ids(self, text: str) -> bytes:
        if PLAIN.fullmatch(text):
            return b"".join(map(self.word.__getitem__, self.words.findall(text.lower())))
        low = self.library.normalizer.normalize_str(text)
        spans = [span for _, span in self.library.pre_tokenizer.pre_tokenize_str(low)]
        return b"".join([self.word[low[a:b]] for a, b in spans])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out = []
        for piece in self.at_added.split(text) if self.at_added else [text]:
            if piece in self.added:
                out.append(np.uint32(self.added[piece]).astype("<u4").tobytes())
            elif piece:
                out += [self._plain_ids(part) for part in self._parts(piece)]
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The tokens with a space between, as a file without a decoder asks; ids of no token give nothing."""
        return " ".join([t for i in np.frombuffer(ids, "<u4").tolist() if (t := self.token.get(i)) is not None])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _each(given: DataFrame, run, made: pa.DataType, schema: str) -> DataFrame:
    """A column made from the second one, behind the given ones, in batches of about ``BATCH`` bytes."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            start, held, got = 0, 0, []
            for i, x in enumerate(b.column(1)):
                got.append(run(x.as_py()))
                held += len(got[-1])
                if held >= BATCH or i + 1 == b.num_rows:
                    part = b.slice(start, len(got))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, made)], [*part.schema.names, "made_"])
                    start, held, got = i + 1, 0, []

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields)
    return mapped(given, batches, f"{kinds}, made_ {schema}")


def encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids`` of every row: little-endian unsigned 32-bit integers."""
    given = spread(docs).select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"))
    got = _each(given, lambda text: encoder(tokenizer).encode(text or ""), pa.binary(), "binary")
    return got.select(F.col("id_").alias(id_col), F.col("made_").alias("ids"))


def decoded(coded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids", carried: bool = False) -> DataFrame:
    """``id_col, text`` of every row of ids (null: empty), with ``carried`` the ids between them."""
    given = coded.select(F.col(id_col).alias("id_"), F.col(ids_col).alias("ids_"))
    got = _each(given, lambda ids: encoder(tokenizer).decode(ids or b""), pa.string(), "string")
    return got.select(F.col("id_").alias(id_col), *([F.col("ids_").alias(ids_col)] if carried else []), F.col("made_").alias("text"))
