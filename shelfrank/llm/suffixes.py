"""Suffix arrays by two-stage sorting, and adjacent common prefixes, on numpy arrays.

Only suffixes smaller than their successors are sorted directly (type S). Every other one (type L) stands in
its first symbol's bucket in the order of its successor, so one scan over the buckets in ascending order
induces them all. The scan is done a bucket at a time: when a bucket is complete, the predecessors of its
suffixes are dealt out to their buckets, in order; within a bucket a round for each further symbol of a run
of that symbol.

A text is an array of bytes in which 0 ends a string. Suffixes are ordered up to ``depth`` symbols or the first 0,
whichever comes first; beyond that, equal ones stand in any order. Where only some suffixes are asked for, those
that they are induced from are added, and no others are sorted.
"""

from __future__ import annotations

import numpy as np

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight symbols from every position on as one big-endian number; zeros follow the text."""
    padded = np.zeros(len(text) + 8, np.uint8)
    padded[:len(text)] = text
    return np.ndarray((len(text),), dtype=">u8", buffer=padded, strides=(1,)).astype(np.uint64)


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor; the last one is not."""
    n = len(text)
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    up = np.zeros(len(ends), bool)
    up[:-1] = text[ends[:-1]] < text[ends[:-1] + 1]
    return np.repeat(up, np.diff(ends, prepend=-1))


def sort_directly(words: np.ndarray, suffixes: np.ndarray, depth: int) -> np.ndarray:
    """``suffixes`` in order: by their first eight symbols, then those still equal by the next eight, and so on."""
    first = words[suffixes]
    order = np.argsort(first)
    out, key = suffixes[order], first[order]
    at, group = np.arange(len(out)), np.zeros(len(out), np.int64)
    for offset in range(8, depth + 8, 8):
        new = np.ones(len(at), bool)
        new[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        group = np.cumsum(new)
        ended = ((key - _ONES) & ~key & _HIGH) != 0  # a 0 among the eight symbols
        open_ = ~(new & np.append(new[1:], True)) & ~ended
        if offset >= depth or not open_.any():
            return out
        at, group = at[open_], group[open_]
        place = np.minimum(out[at] + offset, len(words) - 1)
        key = words[place]
        order = np.lexsort((key, group))
        out[at], key = out[at[order]], key[order]
    return out


def with_sources(wanted: np.ndarray, small: np.ndarray) -> np.ndarray:
    """``wanted``, and for each suffix of type L there its successors up to the first of type S."""
    ends = np.flatnonzero(wanted & ~np.append(wanted[1:], False))  # the last of each run of wanted suffixes
    stops = np.append(np.flatnonzero(small), len(wanted) - 1)
    steps = np.zeros(len(wanted) + 1, np.int64)
    np.add.at(steps, ends, 1)
    np.add.at(steps, stops[np.searchsorted(stops, ends)] + 1, -1)
    return wanted | (np.cumsum(steps[:-1]) > 0)


def induce(text: np.ndarray, small: np.ndarray, directly: np.ndarray, wanted: np.ndarray | None = None) -> np.ndarray:
    """All suffixes (or all ``wanted`` ones) in order, from those of type S (``small``) in order."""
    n = len(text)
    large = ~small if wanted is None else wanted & ~small
    bounds = np.searchsorted(text[directly], np.arange(257))
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    if large[n - 1]:
        pending[text[n - 1]].append(np.array([n - 1]))  # its successor, the empty suffix, is the smallest
    out = []
    for c in range(256):
        scanned, front = [], np.concatenate(pending[c]) if pending[c] else np.zeros(0, np.int64)
        pending[c] = []
        while len(front):
            scanned.append(front)
            before = front[front > 0] - 1
            front = before[(text[before] == c) & large[before]]
        scanned.append(directly[bounds[c]:bounds[c + 1]])
        bucket = np.concatenate(scanned)
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[(text[before] > c) & large[before]]
        symbols = text[before]
        order = np.argsort(symbols, kind="stable")
        before, symbols = before[order], symbols[order]
        heads = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1])) if len(symbols) else []
        for a, b in zip(heads, [*heads[1:], len(symbols)]):
            pending[symbols[a]].append(before[a:b])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def suffix_array(text: np.ndarray, depth: int, words: np.ndarray | None = None, wanted: np.ndarray | None = None) -> np.ndarray:
    """The suffixes of ``text`` in order, up to ``depth`` symbols: all, or the ``wanted`` ones and what they are induced from."""
    if not len(text):
        return np.zeros(0, np.int64)
    words = words_at(text) if words is None else words
    small = smaller_than_next(text)
    if wanted is not None:
        wanted = with_sources(wanted, small)
    direct = np.flatnonzero(small if wanted is None else small & wanted)
    return induce(text, small, sort_directly(words, direct, depth), wanted)


def common_prefixes(words: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """For each suffix of ``order`` the symbols that it shares with the one before it, ``limit`` at most (0 for the first).

    No suffix may end within ``limit`` symbols."""
    shared = np.zeros(len(order), np.int64)
    at = np.arange(1, len(order))
    for offset in range(0, limit, 8):
        differ = words[order[at] + offset] ^ words[order[at - 1] + offset]
        same = differ == 0
        shared[at] += 8
        rest, bits = at[~same], differ[~same]
        for size in (4, 2, 1):  # bytes from the first differing one on: 4 to 8 or 1 to 4, and so on
            upper = bits >= np.uint64(1) << np.uint64(8 * size)
            shared[rest] -= size * upper
            bits = np.where(upper, bits >> np.uint64(8 * size), bits)
        shared[rest] -= 1
        at = at[same]
    return np.minimum(shared, limit)
