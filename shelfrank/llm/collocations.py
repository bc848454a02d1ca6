"""Phrase collocation mining with count transducers (weighted acyclic automata, ``automata``).

1. Counting. A task builds the automaton of the sorted n-grams of each shard of text, cut into prefix ranges (by a
   hash of language and first two words). The automata of a range meet in one task, which unions them and sums the
   weights. Words are counted first, then pairs of frequent words, then phrases of frequent pairs: what is not
   frequent can't be part of a frequent phrase. Shards know the frequent ones by a bitmap of fixed size, which
   lets a few others pass; their counts are exact, and the threshold drops them.
2. Parts. The count transducer of each range is composed with the acceptor of the phrase parts that the other ranges
   ask for. A range asks for a part once, however many of its phrases share it.
3. Scores. The cuts of each phrase are scored with exact integers (decimals of 38 digits) in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfrank.llm import automata as A
from shelfrank.llm import words as W
from shelfrank.llm.tables import FILTER_BITS, Scratch, groups, shuffle_partitions

LEAST, LONGEST, TOP = 100, 5, 2000
#: Bytes of text of a shard.
SHARD = 8 << 20
UNKNOWN = "und"
#: The lowest-scoring cut of a phrase, the first of equal ones; ``div`` on decimals is exact.
BEST = """array_min(transform(sequence(0, size(l) - 1), k -> struct(
    (cast(1000 AS decimal(4, 0)) * cast(a AS decimal(16, 0)) * cast(n AS decimal(18, 0))) div (cast(l[k] AS decimal(19, 0)) * cast(r[k] AS decimal(19, 0))) AS score, k AS k)))"""

_CUT = np.zeros(256, bool)
_CUT[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_WORD = ~_CUT
_WORD[[32, 9]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _hashes(names: pa.Array) -> np.ndarray:
    data, offsets = W.flat(names.cast(pa.large_binary()).view(pa.large_string()))
    return W.hash_ranges(data, offsets[:-1], offsets[1:])


def _joined(hashes: list[np.ndarray]) -> np.ndarray:
    """One hash of a sequence of symbols."""
    out = np.zeros(len(hashes[0]), np.uint64)
    for h in hashes:
        out = W.mix(out * W.GOLDEN + h)
    return out


def _slot(hashes: list[np.ndarray]) -> np.ndarray:
    return (_joined(hashes) & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)


def _range(hashes: list[np.ndarray], ranges: int) -> np.ndarray:
    """The prefix range of sequences that begin with the language and one or two words of these hashes."""
    return (_joined(hashes[:3]) % np.uint64(ranges)).astype(np.int64)


def shard_rows(texts: pa.Array, langs: pa.Array, least: int, most: int, bitmap: np.ndarray | None) -> tuple[np.ndarray, pa.Array]:
    """The n-grams of a shard as rows (language, up to ``most`` words, -1s), one for each place, and the names.

    With a ``bitmap`` all sequences of ``least`` - 1 words or, at most, two words in a row must pass it."""
    data, offsets = W.flat(texts)
    data = _LOWER[data]
    starts, ends, rows = W.split(data, offsets, _WORD)
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[_WORD[data]])])
    vocabulary, ids = A.encoded(words)
    del words, bounds, ends
    row = np.repeat(np.arange(len(texts)), np.diff(rows))
    kinds, lang = A.encoded(pc.fill_null(langs.cast(pa.string()), UNKNOWN).cast(pa.large_binary()))
    lang = lang[row]
    names = pa.concat_arrays([vocabulary, kinds])
    n = len(ids)
    # joins[i]: words i and i + 1 are of one piece.
    piece = np.searchsorted(np.flatnonzero(_CUT[data]), starts)
    joins = np.zeros(n, bool)
    joins[:-1] = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
    good = np.ones(n, bool)
    if bitmap is not None:
        word, kind = _hashes(vocabulary)[ids], _hashes(kinds)[lang]
        if least == 2:
            good = bitmap_passes(bitmap, _slot([kind, word]))
            joins &= good & np.append(good[1:], False)
        else:
            joins[:-1] &= bitmap_passes(bitmap, _slot([kind[:-1], word[:-1], word[1:]]))
    out = np.full((n, most + 1), -1, np.int32)
    out[:, 0], out[:, 1] = len(vocabulary) + lang, ids
    reach, length = np.ones(n, bool), np.ones(n, np.int64)
    for k in range(1, most):
        reach[:n - k + 1] &= joins[k - 1:n] if k <= n else False
        reach[max(0, n - k):] = False
        at = np.flatnonzero(reach)
        out[at, k + 1] = ids[at + k]
        length[at] += 1
    return out[length >= least], names


def bitmap_passes(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bitmap[slots >> 6] >> (slots & 63)) & 1 == 1


def _shards(least: int, most: int, ranges: int, bitmap):
    """The packed automata of the shards of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = None if bitmap is None else bitmap.value
        for batch in batches:
            for lo, hi in W.slices(batch["text"], SHARD):
                rows, names = shard_rows(batch["text"].slice(lo, hi - lo), batch["lang"].slice(lo, hi - lo), least, most, seen)
                if not len(rows):
                    continue
                hashes = _hashes(names)
                heads = [hashes[rows[:, 0]], hashes[rows[:, 1]]]
                if most > 1:
                    heads.append(hashes[rows[:, 2]])
                where = _range(heads, ranges)
                order = np.lexsort([*rows.T[::-1], where])
                packed = A.pack(rows[order], where[order], np.ones(len(rows), np.int64), names)
                yield from pa.Table.from_batches([packed]).to_batches(max_chunksize=64)
    return run


COUNTS = "range long, lang string, phrase string, words int, f long, slot long"


def _union(least: int, most: int, threshold: int, ranges: int):
    """The sums of each range: the frequent n-grams and, if words are counted, the words of each language (words = 0)."""
    def rows(where: int, union: A.Union) -> Iterator[pa.RecordBatch]:
        union.merge()
        hashes = _hashes(union.names)
        for d in range(0 if least == 1 else least, most + 1):
            sequences, weights = union.levels[d]
            keep = weights >= (threshold if d else 1)
            sequences, weights = sequences[keep], weights[keep]
            if not len(weights):
                continue
            names = [union.names.take(pa.array(x)) for x in sequences.T]
            phrase = pc.binary_join_element_wise(*names[1:], pa.scalar(b" ", pa.large_binary())) if d else pa.array([b""] * len(weights), pa.large_binary())
            slot = _slot([hashes[x] for x in sequences.T])
            cols = [pa.array(np.full(len(weights), where)), _string(names[0]), _string(phrase), pa.array(np.full(len(weights), d, np.int32)), pa.array(weights), pa.array(slot)]
            yield from pa.Table.from_arrays(cols, ["range", "lang", "phrase", "words", "f", "slot"]).to_batches(max_chunksize=20_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (where,), parts in groups(batches, ["range"]):
            union = A.Union(most + 1)
            for part in parts:
                union.add(*A.paths(part, most + 1))
            yield from rows(where, union)
    return run


def _string(names: pa.Array) -> pa.Array:
    return names.cast(pa.large_binary()).view(pa.large_string()).cast(pa.string())


def _bitmap(spark: SparkSession, found: DataFrame):
    """A broadcast bitmap of the slots, of 16 MB whatever their number; it is put together on the executors."""
    masks = found.select(F.shiftright("slot", 6).alias("word"), F.expr("shiftleft(1L, cast(slot & 63 AS int))").alias("mask"))
    got = masks.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bitmap[got["word"].to_numpy()] = got["mask"].to_numpy()
    return spark.sparkContext.broadcast(bitmap)


def frequent(spark: SparkSession, docs: DataFrame, scratch: Scratch, threshold: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """(range, lang, phrase, words, f) of all n-grams of up to ``longest`` words with f >= ``threshold``, and rows of no words
    with a range's share of all words of a language."""
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
    ranges = shuffle_partitions(spark)
    found, bitmap = [], None
    for least, most in ((1, 1), (2, 2), (3, longest)):
        if least > longest:
            break
        packed = texts.mapInArrow(_shards(least, most, ranges, bitmap), A.schema(most + 1))
        packed = packed.repartition(ranges, "range").sortWithinPartitions("range")
        found.append(scratch.table(packed.mapInArrow(_union(least, most, threshold, ranges), COUNTS), f"counts-{least}"))
        if least < min(3, longest):
            if bitmap is not None:
                bitmap.unpersist()
            bitmap = _bitmap(spark, found[-1].where("words > 0"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.drop("slot")


def _sequences(rows: pa.Table, longest: int, names: pa.Array | None = None) -> tuple[pa.Array, np.ndarray]:
    """(lang, words) of phrases as index rows over ``names``, or over all names in order; unknown ones are -2."""
    width = longest + 1
    split = pc.split_pattern(rows["phrase"].combine_chunks(), " ")
    sizes = pc.list_value_length(split).to_numpy().astype(np.int64)
    langs = rows["lang"].combine_chunks()
    flat = pa.concat_arrays([langs.cast(pa.large_binary()), split.flatten().cast(pa.large_binary())])
    if names is None:
        names, index = A.encoded(flat)
    else:
        index = pc.fill_null(pc.index_in(flat, names), -2).to_numpy().astype(np.int64)
    out = np.full((len(rows), width), -1, np.int64)
    out[:, 0] = index[:len(rows)]
    out[:, 1:][np.arange(longest) < sizes[:, None]] = index[len(rows):]
    return names, out


def _counter(rows: pa.Table, longest: int) -> tuple[pa.Array, np.ndarray, A.Counter, np.ndarray]:
    """The count transducer of a range: names, its rows in order, itself, and the order of the given rows."""
    names, index = _sequences(rows, longest)
    order = np.lexsort(index.T[::-1])
    return names, index[order], A.Counter(index[order], rows["f"].to_numpy()[order]), order


ASKED = "range long, asker long, lang string, phrase string"


def _asked(longest: int, ranges: int):
    """The parts that a range needs from others, each once: first words, and what follows each cut."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (where,), parts in groups(batches, ["range"]):
            rows = pa.Table.from_batches(parts)
            names, index = _sequences(rows.filter(pc.greater(rows["words"], 1)), longest)
            hashes = _hashes(names)
            sizes = (index >= 0).sum(axis=1) - 1
            wanted = [np.where(np.arange(longest + 1) < 2, index, -1)]
            for k in range(1, longest):
                rest = index[sizes > k]
                moved = np.full_like(rest, -1)
                moved[:, 0], moved[:, 1:longest + 1 - k] = rest[:, 0], rest[:, 1 + k:]
                wanted.append(moved)
            wanted = A.summed(np.concatenate(wanted), np.zeros(sum(map(len, wanted)), np.int64))[0]
            if not len(wanted):
                continue
            one = wanted[:, 2] < 0
            to = np.where(one, _range([hashes[wanted[:, 0]], hashes[wanted[:, 1]]], ranges), _range([hashes[wanted[:, k]] for k in (0, 1, 2)], ranges))
            phrase = _spelled(names, wanted)
            cols = [pa.array(to), pa.array(np.full(len(to), where)), _string(names.take(pa.array(wanted[:, 0]))), phrase]
            yield from pa.Table.from_arrays(cols, ["range", "asker", "lang", "phrase"]).to_batches(max_chunksize=20_000)
    return run


def _spelled(names: pa.Array, rows: np.ndarray) -> pa.Array:
    """The words of index rows, joined by blanks."""
    sizes = (rows >= 0).sum(axis=1) - 1
    flat = names.take(pa.array(rows[:, 1:][rows[:, 1:] >= 0])).cast(pa.large_binary())
    lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)])), flat)
    return _string(pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())))


def _answers(longest: int):
    """The counts of the asked parts (kind 1), by composition with the range's transducer (rows of kind 0, first)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: tuple[int, pa.Array, A.Counter] | None = None
        for (where, kind), parts in groups(batches, ["range", "kind"]):
            if kind == 0:
                names, _, counter, _ = _counter(pa.Table.from_batches(parts), longest)
                own = where, names, counter
                continue
            for part in parts:
                if own is None or own[0] != where:
                    continue
                _, index = _sequences(pa.Table.from_batches([part]), longest, own[1])
                index[(index == -2).any(axis=1)] = -1
                _, count = own[2].walk(index)
                yield pa.RecordBatch.from_arrays([part["asker"], part["lang"], part["phrase"], pa.array(count)], ["range", "lang", "phrase", "f"])
    return run


CUTS = "lang string, phrase string, a long, l array<long>, r array<long>, inner array<string>"


def _cuts(longest: int):
    """The phrases of a range with the counts of their parts at each cut, and the phrases of one word less in them that
    are as frequent. Rows of kind 0 are the range's own counts, those of kind 1 the answers that it has got."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for (_, kind), parts in groups(batches, ["range", "kind"]):
            rows = pa.Table.from_batches(parts)
            if kind == 0:
                held = rows
                continue
            own = held.filter(pc.greater(held["words"], 1))
            both = pa.concat_tables([x.select(["lang", "phrase", "f"]) for x in (own, rows)])
            codes = pa.table({"lang": both["lang"], "phrase": both["phrase"]})
            names, index = _sequences(codes, longest)
            index, first = np.unique(index, axis=0, return_index=True)  # an answer may be of this range
            counter = A.Counter(index, both["f"].to_numpy()[first])
            index = _sequences(own, longest, names)[1]
            a = own["f"].to_numpy()
            sizes = (index >= 0).sum(axis=1) - 1
            left, right = np.zeros((len(index), longest - 1), np.int64), np.zeros((len(index), longest - 1), np.int64)
            for k in range(1, longest):
                part = np.where(np.arange(longest + 1) <= k, index, -1)
                left[:, k - 1] = counter.walk(part)[1]
                part = np.full_like(index, -1)
                part[:, 0], part[:, 1:longest + 1 - k] = index[:, 0], index[:, 1 + k:]
                right[:, k - 1] = counter.walk(part)[1]
            shown = np.arange(longest - 1) < (sizes - 1)[:, None]
            bounds = pa.array(np.concatenate([[0], np.cumsum(sizes - 1)]).astype(np.int32))
            # Of a phrase of three words and more: without its last, and without its first word.
            last = left[np.arange(len(index)), sizes - 2]
            pieces, of = [], []
            for counts, drop in ((last, -1), (right[:, 0], 0)):
                hit = np.flatnonzero((sizes > 2) & (counts == a))
                part = index[hit].copy()
                if drop:
                    part[np.arange(len(hit)), sizes[hit]] = -1
                else:
                    part[:, 1:-1], part[:, -1] = index[hit][:, 2:], -1
                pieces.append(_spelled(names, part))
                of.append(hit)
            of = np.concatenate(of)
            order = np.argsort(of, kind="stable")
            inner = pa.concat_arrays(pieces).take(pa.array(order))
            inner_bounds = pa.array(np.searchsorted(of[order], np.arange(len(index) + 1)).astype(np.int32))
            cols = [own["lang"].combine_chunks(), own["phrase"].combine_chunks(), pa.array(a), pa.ListArray.from_arrays(bounds, pa.array(left[shown])),
                    pa.ListArray.from_arrays(bounds, pa.array(right[shown])), pa.ListArray.from_arrays(inner_bounds, inner)]
            yield from pa.Table.from_arrays(cols, ["lang", "phrase", "a", "l", "r", "inner"]).to_batches(max_chunksize=20_000)
    return run


def _by_range(first: DataFrame, second: DataFrame, ranges: int) -> DataFrame:
    """Rows of both kinds, together by range and the first kind first."""
    both = first.withColumn("kind", F.lit(0)).unionByName(second.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return both.repartition(ranges, "range").sortWithinPartitions("range", "kind")


def phrases(spark: SparkSession, docs: DataFrame, threshold: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two to ``longest`` words of each language of ``docs``
    (text, lang).

    A-Z are lower-cased; texts are cut at ``. , ; : ! ?`` and line breaks into pieces and those at blanks and tabs into
    words. n counts the words of a language, and f(phrase) its occurrences within pieces, overlaps included; a is f of a
    phrase with f >= ``threshold``. A cut after the first words has l = f(these), r = f(the rest) and
    floor(1000 * a * n / (l * r)); the cut with the lowest score counts, the first of equal ones. Phrases that lie in a
    longer one of equal f (up to ``longest`` words) go. Ranks go by score, a (both descending) and phrase (byte order).

    A null text has no words, a null lang is ``und``; other columns don't matter. Repeated rows count as often as they
    occur. An empty table, and one without frequent phrases, gives no rows.
    """
    scratch = Scratch(spark, "collocations")
    ranges = shuffle_partitions(spark)
    counts = scratch.table(frequent(spark, docs, scratch, threshold, longest), "counts")
    scratch.drop("counts-1", "counts-2", "counts-3")
    known = counts.where("words > 0")
    n = counts.where("words = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    asked = known.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(_asked(longest, ranges), ASKED)
    answers = _by_range(known, asked, ranges).select("range", "kind", "asker", "lang", "phrase", "words", "f").mapInArrow(_answers(longest), "range long, lang string, phrase string, f long")
    cuts = _by_range(known, answers, ranges).select("range", "kind", "lang", "phrase", "words", "f").mapInArrow(_cuts(longest), CUTS)
    cuts = scratch.table(cuts, "cuts")

    inside = cuts.select("lang", F.explode("inner").alias("phrase")).distinct()
    rows = cuts.join(inside, ["lang", "phrase"], "left_anti").join(n, "lang").withColumn("best", F.expr(BEST))
    rows = rows.select("lang", "phrase", "a", F.col("l")[F.col("best.k")].alias("l"), F.col("r")[F.col("best.k")].alias("r"), "n", F.col("best.score").alias("score"))
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
