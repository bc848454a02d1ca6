"""Vectorised word and shingle hashing over Arrow string columns (numpy inside Spark tasks).

A column is seen as one UTF-8 byte buffer with row offsets. Every separator that the operators use is
an ASCII character and no byte of a longer UTF-8 sequence is ASCII, so words on bytes are the words
on code points. All functions return flat arrays with per-row offsets; none loops over rows or words
(except over the rare words beyond ``LONG_WORD`` bytes).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

LONG_WORD = 256
#: Texts of one slice are hashed together; the temporary arrays take some 50 bytes for each text byte, and stay in the CPU cache.
SLICE_BYTES = 1 << 20

# The constants of the splitmix64 finaliser and of the 64-bit golden ratio.
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_STEPS = np.arange(1, 65, dtype=np.uint64) * GOLDEN

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: True for the bytes of words that white space (space, \t \n \v \f \r) separates.
SPACED = np.ones(256, dtype=bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False
#: True for ASCII letters (either case), digits and every byte of a non-ASCII character.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], dtype=np.uint64)


class Words(NamedTuple):
    """Words of a slice: byte bounds in ``data``, 64-bit hashes, and for row r the words
    ``rows[r]:rows[r + 1]``."""
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection on 64 bits; works in place on a uint64 array."""
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most about ``size`` bytes of text (one row at least)."""
    _, offsets = flat(column)
    n, at = len(column), 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        end = min(n, max(at + 1, end))
        yield at, end
        at = end


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def split(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row bounds of the maximal runs of bytes with ``letters[byte]``."""
    inside = letters[data]
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    first[heads] = inside[heads]
    last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, eight bytes at a time; equal bytes give equal hashes."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    eights = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    lens = ends - starts
    h = eights[starts] & _MASK[np.minimum(lens, 8)]
    h ^= lens.astype(np.uint64) * GOLDEN
    mix(h)
    more, at = np.flatnonzero((lens > 8) & (lens <= LONG_WORD)), 8
    while len(more):
        part = eights[starts[more] + at] & _MASK[np.minimum(lens[more] - at, 8)]
        h[more] = mix(h[more] * GOLDEN + part)
        at += 8
        more = more[lens[more] > at]
    for i in np.flatnonzero(lens > LONG_WORD):
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def words(column: pa.Array, letters: np.ndarray = SPACED, lower: bool = True) -> Words:
    """Words of every row, with A-Z lower-cased for the hashes unless ``lower`` is false."""
    data, offsets = flat(column)
    starts, ends, rows = split(data, offsets, letters)
    if lower:
        data = _LOWER[data]
    return Words(data, starts, ends, hash_ranges(data, starts, ends), rows)


def shingles(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``size``-word shingles of every row, and row bounds.

    A row of fewer words, but not none, has one shingle: its whole word sequence (it never equals a
    shingle of another length).
    """
    n = len(hashes)
    counts = np.diff(rows)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(rows), np.int64)
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out += mix(padded[j:j + n] + _STEPS[j])
        out *= GOLDEN
    mix(out)
    keep = np.ones(n, bool)
    for j in range(1, size):
        at = rows[1:][counts >= j] - j
        keep[at] = False
    short = np.flatnonzero((counts > 0) & (counts < size))
    for length in range(1, size):
        at = rows[:-1][short[counts[short] == length]]
        h = np.full(len(at), length, np.uint64)
        for j in range(length):
            h += mix(hashes[at + j] + _STEPS[j])
            h *= GOLDEN
        out[at] = mix(h)
        keep[at] = True
    bounds = np.concatenate([[0], np.cumsum(keep)])[rows]
    return out[keep], bounds


def distinct(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every row, and row bounds."""
    values = values.copy()
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
        values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[rows[:-1][rows[:-1] < rows[1:]]] = True
    return values[keep], np.concatenate([[0], np.cumsum(keep)])[rows]
