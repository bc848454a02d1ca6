"""Exact-substring deduplication: bytes covered by a string of ``length`` bytes that also starts earlier.

Matches are adjacent suffixes of suffix arrays (``suffixes``: two-stage sorting) with a common prefix of ``length``
bytes at least. What makes them distributed is a key that all places of a string share:

1. The key of a place is the least hash of the ``GRAM``-byte grams of its string (a minimizer), so neighbouring places
   mostly have one key, and a run of them is one piece of text. Keys that occur once have no match and go no
   further; the others are counted and joined back by Spark.
2. The runs of the other keys travel to their key, with their text. A task sorts the suffixes of one chunk of whole keys
   after another, and reports the places that are the first of their string.
3. What a document has of such keys, but for these places, starts earlier: the bytes that it covers go.

A key of very many places (a common phrase) is made finer by a second and third minimizer under other hashes, so no
chunk grows with the data. Equal runs are one: tasks keep the earliest of a buffer before the shuffle and of
a chunk before the sort, and so a passage that a third of all documents hold arrives a few times for each task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm import suffixes
from shelfrank.llm import words as W
from shelfrank.llm.tables import Scratch

LENGTH = 100
#: Bytes of a gram. Longer grams recur less by chance, but make more and shorter runs.
GRAM = 24
#: Keys of at least so many places (and its square) get a second (and third) minimizer.
HOT = 10_000
#: Bytes of runs that a task holds before it drops repeated ones, and that it sorts at once.
BUFFER, CHUNK = 32 << 20, 2 << 20

#: Texts of one slice are hashed together; the arrays of a quarter of a MB stay in the CPU cache.
SLICE = 1 << 18

#: The low bits of a key stay free for its level.
_KEY = ~np.uint64(3)
_FACTORS = W.mix(np.arange(1, 33, dtype=np.uint64) * W.GOLDEN) | np.uint64(1)


def grams(data: np.ndarray, size: int, seed: int) -> np.ndarray:
    """64-bit hashes of all ``size``-byte grams, eight bytes at a time; equal grams have equal hashes wherever they stand."""
    n = len(data)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = data
    eights = np.ndarray((n + 1,), dtype="<u8", buffer=padded, strides=(1,)).astype(np.uint64)
    if size < 8:
        eights &= np.uint64((1 << 8 * size) - 1)
    eights ^= eights >> np.uint64(32)
    m = n - size + 1
    out = eights[:m] * _FACTORS[0]
    for k, at in enumerate(range(8, size, 8), 1):
        out += eights[min(at, size - 8):][:m] * _FACTORS[k % 32]
    out ^= out >> np.uint64(32)
    out *= W.GOLDEN
    return W.mix(out + np.uint64(seed)) if seed else out


def minima(data: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The least gram hash of each string of ``length`` bytes, and whether its first gram has it; ``seed`` chooses the
    order of the hashes."""
    size = min(GRAM, length)
    hashes = low = grams(data, size, seed)
    width, span = length - size + 1, 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[:span - width], low[width - span:]) if span < width else low
    return low, hashes[:len(low)] == low


class Runs:
    """Runs of places with one key in the texts of a slice: row, first byte in ``data``, number of places, key."""

    def __init__(self, column: pa.Array, length: int):
        self.data, self.offsets = W.flat(column)
        self.length = length
        lens = np.diff(self.offsets)
        self.places = np.zeros(0, np.int64)
        self.keys = np.zeros(0, np.uint64)
        if len(self.data) >= length:
            least, self.leads = minima(self.data, length, 0)
            inside = np.repeat(self.offsets[1:], lens)[:len(least)] >= np.arange(length, len(least) + length)
            self.places, self.keys = np.flatnonzero(inside), least[inside] & _KEY
        self._cut()

    def _cut(self) -> None:
        rows = np.searchsorted(self.offsets, self.places, side="right") - 1
        new = np.ones(len(self.places), bool)
        new[1:] = (self.keys[1:] != self.keys[:-1]) | (rows[1:] != rows[:-1]) | (np.diff(self.places) != 1)
        at = np.flatnonzero(new)
        self.rows, self.starts, self.key = rows[at], self.places[at], self.keys[at]
        self.counts = np.diff(np.append(at, len(self.places)))

    def repeats_inside(self) -> np.ndarray:
        """Runs that may hold a string twice: the key's gram stands at a place, and the next place has the key again."""
        again = self.leads[self.places]
        again[np.cumsum(self.counts) - 1] = False
        return np.add.reduceat(again, np.cumsum(self.counts) - self.counts) > 0

    def among(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """For each run, whether its key is in its row's list of keys | level, and the level (0: not there)."""
        flat, sizes = lists.flatten(), _sizes(lists)
        wanted = flat.to_numpy().astype(np.int64).view(np.uint64)
        ids = np.unique(np.concatenate([self.key, wanted & _KEY]), return_inverse=True)[1].astype(np.int64)
        mine = self.rows << 32 | ids[:len(self.key)]
        theirs = np.repeat(np.arange(len(lists)), sizes) << 32 | ids[len(self.key):]
        order = np.argsort(theirs)
        theirs, level = theirs[order], (wanted & ~_KEY).astype(np.int64)[order]
        place = np.minimum(np.searchsorted(theirs, mine), max(0, len(theirs) - 1))
        found = theirs[place] == mine if len(theirs) else np.zeros(len(mine), bool)
        return found, np.where(found, level[place], 0) if len(theirs) else np.zeros(len(mine), np.int64)

    def keep(self, runs: np.ndarray, levels: np.ndarray) -> None:
        """Only the given runs stay; keys of a higher level get further minimizers, which may split their runs."""
        chosen = np.repeat(runs, self.counts)
        level = np.repeat(levels, self.counts)[chosen]
        self.places, self.keys = self.places[chosen], self.keys[chosen]
        for k in range(2, int(level.max(initial=1)) + 1):
            finer = level >= k
            self.keys[finer] = W.mix(self.keys[finer] * W.GOLDEN + minima(self.data, self.length, k - 1)[0][self.places[finer]])
        self._cut()

    def texts(self) -> pa.Array:
        """The bytes of each run: of its first place, and ``length`` - 1 after its last."""
        return gather(self.data, self.starts, self.counts + self.length - 1)


def _sizes(lists: pa.ListArray) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy()


def gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Byte ranges as a binary column."""
    ends = np.cumsum(sizes)
    index = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[index].tobytes())]).cast(pa.binary())


def _sliced(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in W.slices(batch.column(text), SLICE):
            yield batch.slice(lo, hi - lo)


def _keys(length: int):
    """Distinct (key, doc) of every text, with the number of runs; one that may hold a string twice counts twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            runs = Runs(batch["text"], length)
            if len(runs.key):
                order = np.lexsort((runs.key, runs.rows))
                rows, key = runs.rows[order], runs.key[order]
                first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (rows[1:] != rows[:-1])))
                docs = batch["doc_"].to_numpy()[rows[first]]
                n = np.add.reduceat(1 + runs.repeats_inside()[order], first)
                yield pa.RecordBatch.from_arrays([pa.array(key[first].view(np.int64)), pa.array(docs), pa.array(n.astype(np.int32))], ["key", "doc_", "n"])
    return run


def _distinct(rows: pa.Table) -> pa.Table:
    """The first of the rows of equal text."""
    codes = rows["text"].combine_chunks().dictionary_encode().indices.to_numpy()
    return rows.take(pa.array(np.sort(np.unique(codes, return_index=True)[1])))


_ORDER = [("last_", "ascending"), ("id_", "ascending"), ("doc_", "ascending"), ("start", "ascending")]
RUNS = "key long, text binary, last_ boolean, id_ long, doc_ long, start long"


def _runs(length: int):
    """The runs of a document's listed keys, with their text; of equal ones of a buffer the earliest."""
    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        yield from _distinct(rows.sort_by(_ORDER)).to_batches(max_chunksize=20_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in _sliced(batches):
            runs = Runs(batch["text"], length)
            runs.keep(*runs.among(batch["keys"]))
            if not len(runs.key):
                continue
            rows = pa.array(runs.rows)
            cols = [pa.array(runs.key.view(np.int64)), runs.texts(), *(batch[c].take(rows) for c in ("last_", "id_", "doc_")), pa.array(runs.starts - runs.offsets[runs.rows])]
            held.append(pa.RecordBatch.from_arrays(cols, ["key", "text", "last_", "id_", "doc_", "start"]))
            size += held[-1].nbytes
            if size >= BUFFER:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)
    return run


FIRSTS = "doc_ long, id_ long, start long, n long"


def first_places(rows: pa.Table, length: int) -> pa.RecordBatch:
    """Of whole keys in document order: the runs of places that are the first of their string."""
    rows = _distinct(rows)
    data, offsets = W.flat(rows["text"].combine_chunks().cast(pa.large_binary()).view(pa.large_string()))  # bytes, not valid text
    sizes, n = np.diff(offsets), len(rows)
    text = np.zeros(len(data) + n, np.uint8)
    row = np.repeat(np.arange(n), sizes)
    text[np.arange(len(data)) + row] = data + 1
    begins = offsets[:-1] + np.arange(n)
    whole = np.ones(len(text), bool)  # places with ``length`` bytes in their run
    ends = begins + sizes
    for k in range(length):
        whole[ends - k] = False
    words = suffixes.words_at(text)
    order = suffixes.suffix_array(text, length, words, whole)
    order = order[whole[order]]
    shared = suffixes.common_prefixes(words, order, length)
    heads = np.flatnonzero(shared < length)
    first = np.sort(np.minimum.reduceat(order, heads))
    of = np.searchsorted(begins, first, side="right") - 1
    new = np.flatnonzero(np.append(True, (np.diff(first) != 1) | (of[1:] != of[:-1])))
    of, at = of[new], first[new]
    start = at - begins[of] + rows["start"].to_numpy()[of]
    took = rows.select(["doc_", "id_"]).take(pa.array(of))
    return pa.RecordBatch.from_arrays([took["doc_"].combine_chunks(), took["id_"].combine_chunks(), pa.array(start), pa.array(np.diff(np.append(new, len(first))))],
                                      ["doc_", "id_", "start", "n"])


def _firsts(length: int):
    """``first_places`` of chunks of whole keys; the rows come sorted by key and document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size, most = 0, CHUNK
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            size += batch.nbytes
            if size < most:
                continue
            rows = pa.concat_tables(held)
            keys = rows["key"].to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield first_places(rows.slice(0, cut), length)
            rest = _distinct(rows.slice(cut))  # the last key may go on
            held, size = [rest], rest.nbytes
            most = max(CHUNK, 2 * size)
        if size:
            yield first_places(pa.concat_tables(held), length)
    return run


FOUND = "n_bytes long, spans array<struct<a: long, b: long>>, kept binary"


def _remaining(length: int, columns: list[str]):
    """The texts without the bytes that a string of a listed key covers, unless the string's place is a first one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            runs = Runs(batch["text"], length)
            n = len(runs.data)
            later = np.zeros(n + 1, bool)
            listed = np.repeat(runs.among(batch["keys"])[0], runs.counts)
            later[runs.places[listed]] = True
            firsts, ids = batch["firsts"], batch["id_"].to_numpy()
            flat, row = firsts.flatten(), np.repeat(np.arange(len(firsts)), _sizes(firsts))
            own = flat.field("id_").to_numpy() == ids[row]
            begin = runs.offsets[row[own]] + flat.field("start").to_numpy()[own]
            steps = np.zeros(n + 2, np.int64)
            np.add.at(steps, begin, 1)
            np.add.at(steps, begin + flat.field("n").to_numpy()[own], -1)
            later &= np.cumsum(steps[:n + 1]) == 0
            starts = np.flatnonzero(later)
            steps = np.zeros(n + 1, np.int64)
            steps[starts] += 1
            steps[np.minimum(starts + length, n)] -= 1
            gone = np.cumsum(steps[:n]) > 0
            # Maximal runs of removed bytes in each text.
            a, b, rows = W.split(gone.astype(np.uint8), runs.offsets, np.array([False, True] + [False] * 254))
            base = np.repeat(runs.offsets[:-1], np.diff(rows))
            struct = pa.StructArray.from_arrays([pa.array(a - base), pa.array(b - base)], ["a", "b"])
            left = np.concatenate([[0], np.cumsum(~gone)])[runs.offsets]
            kept = pa.Array.from_buffers(pa.large_binary(), len(batch), [None, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(runs.data[~gone].tobytes())])
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in columns), pa.array(np.diff(runs.offsets)), pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), struct), kept.cast(pa.binary())],
                [*columns, "n_bytes", "spans", "kept"])
    return run


def without_repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` (doc_id, text; other columns pass through, but for those named below) with

    n_bytes: bytes of the text in UTF-8;
    spans: the maximal byte ranges (end exclusive) covered by strings of ``length`` bytes that also start earlier: in a
    document with a smaller doc_id, or before in the same one. All strings are those of the whole input;
    kept: the remaining bytes (a cut may part the bytes of a character).

    A null text is empty. Texts shorter than ``length`` bytes lose nothing. Rows of equal doc_id and text are one
    document and have one result; several texts of one doc_id are ordered by the hash of the text, and rows
    without doc_id come last. Very long texts are whole; an empty table gives an empty one.
    """
    inner = ("n_bytes", "spans", "kept", "keys", "firsts", "doc_", "id_", "last_")
    docs = docs.drop(*inner).withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    columns = docs.columns
    docs = docs.withColumns({"doc_": F.xxhash64("doc_id", "text"), "id_": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "last_": F.col("doc_id").isNull()})
    scratch = Scratch(spark, "repeats")

    places = docs.select("text", "doc_").mapInArrow(_keys(length), "key long, doc_ long, n int")
    counts = places.groupBy("key").agg(F.sum("n").alias("total")).where("total > 1")
    level = F.when(F.col("total") >= HOT * HOT, 3).when(F.col("total") >= HOT, 2).otherwise(1).cast("long")
    listed = places.select("key", "doc_").join(counts, "key").groupBy("doc_").agg(F.collect_set(F.col("key").bitwiseOR(level)).alias("keys"))
    listed = scratch.table(listed, "keys")

    runs = docs.select("doc_", "text", "id_", "last_").join(listed, "doc_").mapInArrow(_runs(length), RUNS)
    runs = runs.repartition("key").sortWithinPartitions("key", "last_", "id_", "doc_", "start")
    firsts = runs.mapInArrow(_firsts(length), FIRSTS).groupBy("doc_").agg(F.collect_list(F.struct("id_", "start", "n")).alias("firsts"))
    listed = scratch.table(listed.join(firsts, "doc_", "left"), "firsts")
    scratch.drop("keys")

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(columns).schema.fields)
    return docs.join(listed, "doc_", "left").mapInArrow(_remaining(length, columns), f"{kinds}, {FOUND}")


def report(found: DataFrame) -> DataFrame:
    """Per document: bytes, bytes removed, removed runs, and the digest of the remaining bytes."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["b"] - x["a"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
