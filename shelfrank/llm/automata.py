"""Weighted acyclic automata of symbol sequences, as arrays, and their union and composition.

A path from the root spells a sequence; the weight of an arc is the count of all sequences that begin with the
path up to it, so one automaton counts every prefix. It is built level by level from sorted sequences: a row
that differs from the one before in its first d symbols opens a new state at depth d, and its weight is the sum over
the prefix range that ends with the next one. States with equal arcs (symbols, weights and targets) are then merged
from the deepest level up, so common tails are stored once.

Many automata are made at a time, one for each range of rows; the arrays of a range are the bytes of one row, as they
travel through Spark.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shelfrank.llm.words import GOLDEN, mix


class Level(NamedTuple):
    """Arcs at one depth: the states that they leave (``sizes`` arcs each, in order), symbols, weights, and the
    states that they enter at the next depth (-1: none)."""
    sizes: np.ndarray
    symbols: np.ndarray
    weights: np.ndarray
    targets: np.ndarray


def _tree(rows: np.ndarray, groups: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Group of each root, and for each depth (parent, symbol, weight) of the nodes of the prefix tree."""
    n, depth = rows.shape
    new = np.ones(n, bool)
    new[1:] = groups[1:] != groups[:-1]
    roots, node = groups[new], np.cumsum(new) - 1
    levels = []
    for d in range(depth):
        column = rows[:, d]
        new[1:] |= column[1:] != column[:-1]
        has = column >= 0
        heads = np.flatnonzero(new & has)
        own = np.cumsum(new & has) - 1
        weight = np.zeros(len(heads), np.int64)
        np.add.at(weight, own[has], counts[has])
        levels.append((node[heads], column[heads], weight))
        node = own
    return roots, levels


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The concatenated ranges start .. start + size."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def build(rows: np.ndarray, groups: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[Level], list[np.ndarray]]:
    """Minimal automata of sorted ``rows`` (sequences, ended by -1s) of each of the sorted ``groups``: the groups, the
    levels, and for each level the group (an index) of its states. States of one group stand together."""
    roots, tree = _tree(rows, groups, counts)
    of = [np.arange(len(roots))]  # group index of the nodes that the arcs of a level leave
    for parent, _, _ in tree[:-1]:
        of.append(of[-1][parent])
    levels: list[Level] = []
    owners: list[np.ndarray] = []
    entered: np.ndarray | None = None  # the state that each node of the level is merged into
    for d in range(len(tree) - 1, -1, -1):
        parent, symbol, weight = tree[d]
        target = np.full(len(symbol), -1, np.int64) if entered is None else entered
        size = np.bincount(parent, minlength=len(of[d]))
        first = np.cumsum(size) - size
        state = np.full(len(size), -1, np.int64)
        nodes = np.flatnonzero(size)
        if d == 0:
            chosen = nodes
            state[nodes] = np.arange(len(nodes))
        else:
            code = mix(mix(symbol.astype(np.uint64) + GOLDEN) * GOLDEN + mix(weight.astype(np.uint64)) + target.astype(np.uint64) * GOLDEN)
            sign = np.add.reduceat(code, first[nodes]) if len(nodes) else np.zeros(0, np.uint64)
            order = np.lexsort((sign, of[d][nodes]))
            group, sign = of[d][nodes][order], sign[order]
            new = np.ones(len(order), bool)
            new[1:] = (group[1:] != group[:-1]) | (sign[1:] != sign[:-1])
            chosen = nodes[order[new]]
            merged = chosen[np.cumsum(new) - 1]  # for the nodes in order
            a = _spread(first[nodes[order]], size[nodes[order]])
            same = (size[merged] == size[nodes[order]]).all()
            if same:
                b = _spread(first[merged], size[merged])
                same = all((x[a] == x[b]).all() for x in (symbol, weight, target))
            if not same:  # two different states with one hash: none of the level are merged
                chosen, new = nodes[order], np.ones(len(order), bool)
            state[nodes[order]] = np.cumsum(new) - 1
        arcs = _spread(first[chosen], size[chosen])
        levels.append(Level(size[chosen], symbol[arcs], weight[arcs], target[arcs]))
        owners.append(of[d][chosen])
        entered = state
    return roots, levels[::-1], owners[::-1]


def schema(depth: int) -> str:
    """Columns of the rows of ``pack``."""
    levels = ", ".join(f"sizes{d} binary, symbols{d} binary, weights{d} binary, targets{d} binary" for d in range(depth))
    return f"range long, names binary, lengths binary, {levels}"


def _coded(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Numbers from 0 on, range by range, in as few bytes each as a range's largest needs; their width comes first."""
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        part = values[a:b]
        kind = np.min_scalar_type(int(part.max(initial=0)))
        out.append(bytes([kind.itemsize]) + part.astype(kind).tobytes())
    return pa.array(out, pa.binary())


def _decoded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows, and how many each row has."""
    parts = [np.frombuffer(x, dtype=f"<u{x[0]}", offset=1) for x in column.to_pylist()]
    return np.concatenate(parts).astype(np.int64), np.array([len(x) for x in parts], np.int64)


def pack(rows: np.ndarray, ranges: np.ndarray, counts: np.ndarray, names: pa.Array) -> pa.RecordBatch:
    """One row for each range: its automaton, over those of the ``names`` that it uses."""
    roots, levels, owners = build(rows, ranges, counts)
    index = np.arange(len(roots) + 1)
    leaves = [np.searchsorted(o, index) for o in owners]  # bounds of the states of each range
    arcs = [np.concatenate([[0], np.cumsum(x.sizes)])[b] for x, b in zip(levels, leaves)]
    owner = np.concatenate([np.repeat(index[:-1], np.diff(b)) for b in arcs])
    used, place = np.unique(owner << 32 | np.concatenate([x.symbols for x in levels]).astype(np.int64), return_inverse=True)
    bounds = np.searchsorted(used, index << 32)
    place = np.split(place - bounds[owner], np.cumsum([len(x.symbols) for x in levels])[:-1])
    own = names.take(pa.array(used & 0xFFFFFFFF)).cast(pa.large_binary())
    offsets = np.frombuffer(own.buffers()[1], np.int64)[own.offset:own.offset + len(own) + 1]
    text = own.buffers()[2].to_pybytes() if len(own) else b""
    spelled = [text[offsets[a]:offsets[b]] for a, b in zip(bounds[:-1], bounds[1:])]
    columns, titles = [pa.array(roots.astype(np.int64)), pa.array(spelled, pa.binary()), _coded(np.diff(offsets), bounds)], ["range", "names", "lengths"]
    for d, level in enumerate(levels):
        entered = level.targets + 1
        if d + 1 < len(levels):
            base = np.repeat(leaves[d + 1][:-1], np.diff(arcs[d]))
            entered = np.where(level.targets >= 0, entered - base, 0)
        else:
            entered = entered[:0]
        columns += [_coded(level.sizes, leaves[d]), _coded(place[d], arcs[d]), _coded(level.weights, arcs[d]), _coded(entered, arcs[d] if len(entered) else np.zeros_like(arcs[d]))]
        titles += [f"{x}{d}" for x in ("sizes", "symbols", "weights", "targets")]
    return pa.RecordBatch.from_arrays(columns, titles)


def paths(batch: pa.RecordBatch, depth: int) -> tuple[pa.Array, list[tuple[np.ndarray, np.ndarray]]]:
    """All paths of the packed automata of a batch: names, and for each depth the sequences (indices of names) and weights."""
    lengths, names_of_row = _decoded(batch["lengths"])
    ends = np.concatenate([[0], np.cumsum(lengths)])
    names = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(batch["names"].to_pylist()))])
    first_name = np.cumsum(names_of_row) - names_of_row
    out = []
    for d in range(depth):
        size, states_of_row = _decoded(batch[f"sizes{d}"])
        symbol, arcs_of_row = _decoded(batch[f"symbols{d}"])
        symbol = (symbol + np.repeat(first_name, arcs_of_row)).astype(np.int32)
        weight = _decoded(batch[f"weights{d}"])[0]
        if d == 0:
            arcs = np.arange(len(symbol))
            sequence = symbol[:, None]
        else:
            base = np.cumsum(states_of_row) - states_of_row
            row = np.repeat(np.arange(batch.num_rows), before_arcs_of_row)[arcs]
            go = target[arcs] >= 0
            state = target[arcs][go] + base[row[go]]
            sequence = np.repeat(sequence[go], size[state], axis=0)
            arcs = _spread((np.cumsum(size) - size)[state], size[state])
            sequence = np.column_stack([sequence, symbol[arcs]])
        out.append((sequence, weight[arcs]))
        target, before_arcs_of_row = _decoded(batch[f"targets{d}"])[0] - 1, arcs_of_row
    return names, out


def summed(rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, with the sums of their weights."""
    if not len(rows):
        return rows, weights
    order = np.lexsort(rows.T[::-1])
    rows = rows[order]
    heads = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1)))
    return rows[heads], np.add.reduceat(weights[order], heads)


def encoded(names: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct names in byte order, and the index of each name there."""
    coded = names.cast(pa.large_binary()).dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int32)
    rank[order.to_numpy()] = np.arange(len(order), dtype=np.int32)
    return coded.dictionary.take(order), rank[coded.indices.to_numpy()]


class Union:
    """The union of automata: weights of equal paths are summed. ``add`` keeps what it holds near the distinct paths."""

    def __init__(self, depth: int, most: int = 1 << 21):
        self.depth, self.most = depth, most
        self.names = pa.array([], pa.large_binary())
        self.levels = [(np.zeros((0, d + 1), np.int32), np.zeros(0, np.int64)) for d in range(depth)]
        self.held: list[tuple[pa.Array, list[tuple[np.ndarray, np.ndarray]]]] = []
        self.size = 0

    def add(self, names: pa.Array, levels: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.held.append((names, levels))
        self.size += sum(len(w) for _, w in levels)
        if self.size >= max(self.most, sum(len(w) for _, w in self.levels)):
            self.merge()

    def merge(self) -> None:
        parts = [(self.names, self.levels), *self.held]
        names, index = encoded(pa.concat_arrays([n.cast(pa.large_binary()) for n, _ in parts]))
        base = np.cumsum([0, *(len(n) for n, _ in parts)])
        self.levels = [summed(np.concatenate([index[rows[d][0] + b] if len(index) else rows[d][0] for b, (_, rows) in zip(base, parts)]),
                              np.concatenate([rows[d][1] for _, rows in parts])) for d in range(self.depth)]
        self.names, self.held, self.size = names, [], 0


class Counter:
    """A count transducer for look-ups: arcs sorted by the state that they leave and their symbol."""

    def __init__(self, rows: np.ndarray, counts: np.ndarray):
        """``rows``: distinct sequences in order, ended by -1s, each with its own count (not that of its extensions)."""
        lengths = (rows >= 0).sum(axis=1)
        self.levels = []
        _, tree = _tree(rows, np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64))
        for d, (parent, symbol, _) in enumerate(tree):
            count = np.zeros(len(symbol), np.int64)
            key = parent << 32 | symbol.astype(np.int64)
            self.levels.append((key, count))
        state, _ = self.walk(rows)
        for d in range(rows.shape[1]):
            ends = lengths == d + 1
            self.levels[d][1][state[ends]] = counts[ends]

    def walk(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Composition with the acceptor of ``rows``: for each sequence the state that it ends in (-1: none) and the count
        there (0: none)."""
        state, count = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for (key, counts), symbol in zip(self.levels, rows.T):
            go = (symbol >= 0) & (state >= 0)
            asked = state[go] << 32 | symbol[go].astype(np.int64)
            place = np.minimum(np.searchsorted(key, asked), max(0, len(key) - 1))
            found = key[place] == asked if len(key) else np.zeros(len(asked), bool)
            state[go] = np.where(found, place, -1)
            count[go] = np.where(found, counts[place] if len(key) else 0, 0)
        return state, count
