"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

The automaton accepts every word sequence that occurs in some item. Document words stream through it:
after each word the state stands for the longest sequence, ending here, that occurs in an item. Spans
of at least ``window`` words (or a whole shorter item) are hits. The automaton is built on an executor
from a bounded number of item words; more items make more automata. As many as ``PASS_BYTES`` allow are
broadcast and matched in one pass over the documents, whose words are hashed once; only beyond that there
is another pass, so what a task holds does not grow with the items.
"""

from __future__ import annotations

import pickle
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm import words as W
from shelfrank.llm.tables import Scratch, replaced

WINDOW = 10
#: Item words in one automaton at most; it bounds what is built in one task.
SHARD_WORDS = 100_000
#: Bytes of the pickled automata of one pass (one automaton at least); it bounds what is broadcast.
PASS_BYTES = 32 << 20
#: In ``Automaton.word``: the state has no successor, or several.
NONE, SEVERAL = -1, -2


class Automaton(NamedTuple):
    """Most states have one successor; these are two numbers, not a dict."""
    window: int
    vocabulary: np.ndarray  # sorted word hashes; a word's number is its place
    word: array  # the word to the state's only successor, or NONE or SEVERAL
    target: array  # that successor
    several: dict[int, dict[int, int]]  # state -> word -> successor, where there are several
    link: array
    longest: array
    sets: list[tuple]  # distinct lists of items that share a window
    found: array  # place in sets of the items that have the state's window-long suffix, for states of at least window words
    shorts: dict[int, list]  # state -> (words, item) of the shorter items that end here
    next_short: array  # nearest state on the suffix chain, itself included, with shorts; else -1
    least: int  # words of the shortest window


def build(items: list[tuple[object, np.ndarray]], window: int = WINDOW) -> Automaton:
    """The automaton of items given as (item_id, word hashes); wordless items are left out."""
    items = [(i, w) for i, w in items if len(w)]
    vocabulary = np.unique(np.concatenate([w for _, w in items])) if items else np.zeros(0, np.uint64)
    texts = [(i, np.searchsorted(vocabulary, w).tolist()) for i, w in items]
    step: list[dict[int, int]] = [{}]
    link, longest = [-1], [0]

    def split_state(p: int, q: int, word: int) -> int:
        """A copy of q for the shorter sequences that reach it from p and p's suffixes."""
        copy = len(step)
        step.append(dict(step[q]))
        link.append(link[q])
        longest.append(longest[p] + 1)
        while p >= 0 and step[p].get(word) == q:
            step[p][word] = copy
            p = link[p]
        link[q] = copy
        return copy

    for _, text in texts:
        last = 0
        for word in text:
            q = step[last].get(word)
            if q is not None:
                last = q if longest[q] == longest[last] + 1 else split_state(last, q, word)
                continue
            new, p = len(step), last
            step.append({})
            link.append(0)
            longest.append(longest[last] + 1)
            while p >= 0 and word not in step[p]:
                step[p][word] = new
                p = link[p]
            if p >= 0:
                q = step[p][word]
                link[new] = q if longest[q] == longest[p] + 1 else split_state(p, q, word)
            last = new

    by_length = sorted(range(len(step)), key=longest.__getitem__)
    at_window = [-1] * len(step)
    for s in by_length:
        if longest[s] >= window:
            at_window[s] = s if longest[link[s]] < window else at_window[link[s]]
    windows: dict[int, list] = {}
    shorts: dict[int, list] = {}
    for item, text in texts:
        state = 0
        for i, word in enumerate(text):
            state = step[state][word]
            if i + 1 >= window:
                found = windows.setdefault(at_window[state], [])
                if not found or found[-1] != item:
                    found.append(item)
        if len(text) < window:
            shorts.setdefault(state, []).append((len(text), item))
    next_short = [-1] * len(step)
    for s in by_length[1:]:
        next_short[s] = s if s in shorts else next_short[link[s]]
    least = min([window, *(n for x in shorts.values() for n, _ in x)])
    sets: dict[tuple, int] = {(): 0}
    place = {s: sets.setdefault(tuple(ids), len(sets)) for s, ids in windows.items()}
    ways = [next(iter(x.items())) if len(x) == 1 else (SEVERAL if x else NONE, 0) for x in step]
    return Automaton(
        window, vocabulary, array("i", [w for w, _ in ways]), array("i", [t for _, t in ways]), {s: x for s, x in enumerate(step) if len(x) > 1},
        array("i", link), array("i", longest), list(sets), array("i", [place.get(s, 0) for s in at_window]), shorts, array("i", next_short), least)


def match(a: Automaton, text: list[int]) -> tuple[list[tuple[int, int]], set]:
    """Hit word ranges (start, end) of a run of word numbers, not yet merged, and the items hit."""
    only, target, several, link, longest, window = a.word, a.target, a.several, a.link, a.longest, a.window
    state = length = 0
    spans: list[tuple[int, int]] = []
    items: set = set()
    for i, word in enumerate(text):
        while True:
            way = only[state]
            nxt = target[state] if way == word else several[state].get(word) if way == SEVERAL else None
            if nxt is not None or not state:
                break
            state = link[state]
            length = longest[state]
        if nxt is None:
            length = 0
            continue
        state = nxt
        length += 1
        if length >= window:
            spans.append((i + 1 - window, i + 1))
            items.update(a.sets[a.found[state]])
        short = a.next_short[state]
        while short > 0:
            for n, item in a.shorts[short]:
                if n <= length:
                    spans.append((i + 1 - n, i + 1))
                    items.add(item)
            short = a.next_short[link[short]]
    return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def merged_cuts(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Word ranges with their code point ranges, merged where the word ranges touch."""
    out: list[tuple[int, int, int, int]] = []
    for a, b, x, y in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), out[-1][2], max(y, out[-1][3]))
        else:
            out.append((a, b, x, y))
    return out


def scan(automata: list[Automaton], column: pa.Array) -> Iterator[tuple[int, list[tuple[int, int]], list[tuple[int, int]], set]]:
    """For every text: number of words, hit word ranges, the same in code points, items hit.

    Only runs of words that occur in an automaton's items, as long as its shortest window, reach it."""
    for lo, hi in W.slices(column):
        w = W.words(column.slice(lo, hi - lo), W.ALNUM)
        offsets = W.flat(column.slice(lo, hi - lo))[1]
        spans: list[list[tuple[int, int]]] = [[] for _ in range(hi - lo)]
        items: list[set] = [set() for _ in range(hi - lo)]
        for a in automata:
            place = np.searchsorted(a.vocabulary, w.hashes)
            place[place == len(a.vocabulary)] = 0
            known = a.vocabulary[place] == w.hashes if len(a.vocabulary) else np.zeros(len(w.hashes), bool)
            starts, ends, rows = W.split(known.astype(np.uint8), w.rows, np.array([False, True] + [False] * 254))
            long_enough = ends - starts >= a.least
            rows = np.concatenate([[0], np.cumsum(long_enough)])[rows]
            starts, ends = starts[long_enough], ends[long_enough]
            for r in np.flatnonzero(np.diff(rows)).tolist():
                first = int(w.rows[r])
                for s, e in zip(starts[rows[r]:rows[r + 1]].tolist(), ends[rows[r]:rows[r + 1]].tolist()):
                    found, hit = match(a, place[s:e].tolist())
                    spans[r] += [(x + s - first, y + s - first) for x, y in found]
                    items[r] |= hit
        for r in range(hi - lo):
            first, hits = int(w.rows[r]), merged(spans[r])
            places, at, points = [], int(offsets[r]), 0
            for x, y in hits:  # code points from one bound to the next: all bytes but continuation bytes
                bounds = []
                for bound in (int(w.starts[first + x]), int(w.ends[first + y - 1])):
                    points += int(np.count_nonzero(w.data[at:bound] & 0xC0 != 0x80))
                    at = bound
                    bounds.append(points)
                places.append((bounds[0], bounds[1]))
            yield int(w.rows[r + 1] - first), hits, places, items[r]


def _build_shards(window: int, most: int):
    """Pack the items of a partition into automata of at most ``most`` words. A longer item goes in
    pieces that overlap by window - 1 words, which have the same windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[object, np.ndarray]] = []
        size = 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(tuple(build(held, window)))], pa.binary())], names=["automaton"])

        for batch in batches:
            w = W.words(batch.column("text"), W.ALNUM)
            for r, item in enumerate(batch.column("item_id").to_pylist()):
                text = w.hashes[w.rows[r]:w.rows[r + 1]]
                for at in range(0, max(1, len(text) - window + 1), max(1, most - window + 1)):
                    piece = text[at:at + most]
                    if held and size + len(piece) > most:
                        yield out()
                        held, size = [], 0
                    held.append((item, piece))
                    size += len(piece)
        if held:
            yield out()
    return run


def automata(items: DataFrame, window: int = WINDOW, most: int = SHARD_WORDS) -> Iterator[bytes]:
    """Pickled automata of the items (item_id, text), each of at most ``most`` words, one at a time."""
    table = items.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chars = table.agg(F.sum(F.length("text"))).first()[0] or 0
    packed = table.repartition(max(1, -(-chars // (2 * most))))  # a word and its separator have two characters at least
    for row in packed.mapInArrow(_build_shards(window, most), "automaton binary").toLocalIterator():
        yield bytes(row["automaton"])


def passes(blobs: Iterator[bytes], most_bytes: int) -> Iterator[list[bytes]]:
    """The automata in groups of at most so many bytes, one at least in each."""
    held: list[bytes] = []
    for blob in blobs:
        if held and sum(map(len, held)) + len(blob) > most_bytes:
            yield held
            held = []
        held.append(blob)
    if held:
        yield held


def _scan_batches(blobs, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [Automaton(*pickle.loads(blob)) for blob in blobs.value]
        for whole in batches:
            for lo, hi in W.slices(whole.column("text")):
                batch = whole.slice(lo, hi - lo)
                found = list(scan(automata, batch.column("text")))
                words = [x[0] for x in found]
                hits = [[{"a": a, "b": b} for a, b in x[1]] for x in found]
                cuts = [[{"a": a, "b": b} for a, b in x[2]] for x in found]
                items = [[str(i) for i in x[3] if i is not None] for x in found]
                if "hits" in keep:  # what earlier passes have found
                    was = [batch.column(c).to_pylist() for c in ("hits", "cuts", "items")]
                    both = [merged_cuts([(h["a"], h["b"], c["a"], c["b"]) for h, c in (*zip(x, y), *zip(hit, cut))])
                            for x, y, hit, cut in zip(was[0], was[1], hits, cuts)]
                    hits = [[{"a": s[0], "b": s[1]} for s in spans] for spans in both]
                    cuts = [[{"a": s[2], "b": s[3]} for s in spans] for spans in both]
                    items = [sorted({*x, *y}) for x, y in zip(was[2], items)]
                span = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
                own = [c for c in keep if c not in ("n_words", "hits", "cuts", "items")]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in own), pa.array(words, pa.int64()), pa.array(hits, span), pa.array(cuts, span),
                     pa.array([sorted(set(x)) for x in items], pa.list_(pa.string()))],
                    names=[*own, "n_words", "hits", "cuts", "items"])
    return run


FOUND = "n_words long, hits array<struct<a: long, b: long>>, cuts array<struct<a: long, b: long>>, items array<string>"


def find(spark: SparkSession, docs: DataFrame, items: DataFrame, window: int = WINDOW, most: int = SHARD_WORDS,
         most_bytes: int = PASS_BYTES) -> DataFrame:
    """``docs`` (with a string column text; other columns pass through, but for the four names below) with

    n_words: number of words (runs of ASCII letters, digits and non-ASCII characters; A-Z lower-cased);
    hits: word ranges covered by windows of the items, end exclusive; a window is ``window`` consecutive
    words of an item, or a whole shorter item that has words;
    cuts: the same ranges in code points of the text;
    items: the item_ids with a window here, as sorted strings. Items without item_id count as hits only.

    ``most`` bounds the item words of an automaton, ``most_bytes`` the automata of a pass over the documents. Between passes the rows
    are a table in the shared folder; a table that the next pass has read is dropped. A null text has no words. Without items, or without words in them, nothing is hit.
    """
    out = docs.drop("n_words", "hits", "cuts", "items").withColumn("text", F.col("text").cast("string"))
    scratch = Scratch(spark, "decontaminate")

    def scanned(rows: DataFrame, blobs: list[bytes]) -> DataFrame:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name not in ("n_words", "hits", "cuts", "items"))
        return rows.mapInArrow(_scan_batches(spark.sparkContext.broadcast(blobs), rows.columns), f"{schema}, {FOUND}")

    n = 0
    for blobs in passes(automata(items, window, most), most_bytes):
        if n:
            out = scratch.table(out, f"pass-{n}")
            if n > 1:
                scratch.drop(f"pass-{n - 1}")
        n += 1
        out = scanned(out, blobs)
    return out if n else scanned(out, [])


def remove(found: DataFrame, max_coverage: float = 0.5, max_span: int = WINDOW) -> DataFrame:
    """The rows of ``find`` with every hit span of at least ``max_span`` words cut out of the text, and
    without the documents of which hits cover more than ``max_coverage`` of the words. n_chars, if there
    is such a column, is the new length."""
    covered = F.aggregate("hits", F.lit(0).cast("long"), lambda s, x: s + x["b"] - x["a"])
    cut = F.transform(F.filter(F.arrays_zip("hits", "cuts"), lambda x: x["hits"]["b"] - x["hits"]["a"] >= max_span),
                      lambda x: x["cuts"])
    rows = found.where((covered == 0) | (covered <= max_coverage * F.col("n_words")))

    rows = rows.withColumn("text", replaced(F.col("text"), cut, "a", "b", ""))
    if "n_chars" in rows.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(rows.schema["n_chars"].dataType))
    return rows.drop("n_words", "hits", "cuts", "items")


def report(found: DataFrame) -> DataFrame:
    """Per document: words, words hit, items, the digest of the item list, and whether any word is hit."""
    return found.select(
        "doc_id", "n_words",
        F.aggregate("hits", F.lit(0).cast("long"), lambda s, x: s + x["b"] - x["a"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))
