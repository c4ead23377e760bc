"""Text columns as numpy arrays: the bytes of many rows at once.

A task sees Arrow batches; each is cut into runs of rows of about
``CHUNK`` bytes (a longer row is a run of its own), so the arrays that
the operators make stay small whatever the batch holds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are turned into arrays at once.
CHUNK = 1 << 21
U64 = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240229))
#: A random 64-bit value for each byte, and an odd base of the polynomial.
BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Odd multipliers that tell the places of a tuple apart.
PLACE = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)
#: ASCII white space.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: list[np.ndarray] = []


def _power(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i mod 2**64 for i < n, at least."""
    if not _powers or len(_powers[0]) < n:
        _powers[:] = [_power(BASE, max(n, CHUNK + 1)), _power(INVERSE, max(n, CHUNK + 1))]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i] = sum of BYTE[data[x]] * BASE**x over i <= x < j."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end) by their bytes alone."""
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64) * PLACE[63])


#: Spans from so many bytes on have a digest of their own: powers modulo 2**64 of any
#: base give some strings of 1,024 bytes (Thue-Morse) equal hashes.
LONG = 256


def exact_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """As :func:`span_hash`, with a cryptographic digest for the long spans."""
    out = span_hash(prefix_hash(data), start, end)
    for k in np.flatnonzero(end - start >= LONG):
        out[k] = int.from_bytes(hashlib.blake2b(data[start[k] : end[k]].tobytes(), digest_size=8).digest(), "little")
    return out


def text_chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``first row, bytes, offsets`` of runs of rows; a null is an empty text."""
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, where, raw = column.buffers()
    offsets = np.frombuffer(where, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        last = min(last, n)
        yield row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, end`` of the words of the rows and the first word of each row (one more at the end)."""
    return class_spans(~SPACE[data], offsets)


def class_spans(kind: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of one non-zero kind within a row: ``start, end`` and each row's first run."""
    n = len(kind)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = kind.astype(np.int8)
    turn = np.empty(n + 1, bool)
    turn[0] = turn[n] = True
    np.not_equal(kind[1:], kind[:-1], out=turn[1:n])
    turn[offsets] = True
    cut = np.flatnonzero(turn)
    word = kind[cut[:-1]] > 0
    start, end = cut[:-1][word], cut[1:][word]
    return start, end, np.searchsorted(start, offsets)


def as_longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def long_lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """list<int64> column from concatenated 64-bit values."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), as_longs(np.ascontiguousarray(values)))
