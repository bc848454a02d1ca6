"""Language identification: word first, backing off to ever shorter character n-grams.

A known word scores by its log frequency in each language. A word that training has not seen scores by
its character n-grams of the longest order of which it has a known one; none of four, then three, then
two, then single characters. Words are runs of letters, lower-cased; n-grams include one mark for each
word boundary. Words and n-grams are 64-bit hashes of their code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from shelfrank.llm import words as W
from shelfrank.llm.tables import Scratch

ORDERS = (4, 3, 2, 1)
#: Labelled rows of each language that are learnt from, about, those with the smallest hashed doc_id.
TRAIN_ROWS = 4_000
#: Entries of all tables together, shared out among the languages; it bounds what is broadcast (20 bytes
#: an entry and 4 a language). Orders get these parts of a language's share; 0 is whole words.
ENTRIES = 400_000
PARTS = {0: 0.4, 4: 0.3, 3: 0.2, 2: 0.08, 1: 0.02}
#: Added to every count.
SMOOTH = 0.5
#: Words after which a score counts the evidence as full.
EVIDENCE = 12
UNKNOWN = "und"

_POWERS = np.ones(4096, np.uint64)
for _i in range(1, 4096):
    _POWERS[_i] = (int(_POWERS[_i - 1]) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF


class Model(NamedTuple):
    languages: list[str]
    keys: dict[int, np.ndarray]  # order (0: words) -> sorted hashes
    logs: dict[int, np.ndarray]  # order -> entries x languages, log frequency


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


class Letters(NamedTuple):
    """Code points of a slice with 0 for every other than a letter, word bounds, and words of each row."""
    points: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray


def letters(texts: list[str]) -> Letters:
    """Texts are joined with a 0 before, between and after them, so every word has a boundary on both sides."""
    lower = [t.lower() for t in texts]
    points = np.frombuffer(("\0" + "\0".join(lower) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _letters()[points]
    points = np.where(inside, points, 0).astype(np.uint64)
    change = np.diff(inside.astype(np.int8))
    starts, ends = np.flatnonzero(change == 1) + 1, np.flatnonzero(change == -1) + 1
    bounds = np.concatenate([[1], 1 + np.cumsum([len(t) + 1 for t in lower])]) if lower else np.array([1])
    return Letters(points, starts, ends, np.searchsorted(starts, bounds))


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each start in turn."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


def word_hashes(x: Letters) -> np.ndarray:
    if not len(x.starts):
        return np.zeros(0, np.uint64)
    sizes = x.ends - x.starts
    at = _spread(x.starts, sizes)
    place = at - np.repeat(x.starts, sizes)
    # Places beyond the table repeat it with other code points.
    mixed = (x.points[at] + (place >> 12).astype(np.uint64) * np.uint64(0x200000)) * W.GOLDEN
    mixed ^= mixed >> np.uint64(29)
    sums = np.add.reduceat(mixed * _POWERS[place & 4095], np.cumsum(sizes) - sizes)
    return W.mix(sums + sizes.astype(np.uint64))


def gram_hashes(x: Letters, which: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of the words numbered ``which``, and their count for each of them. Orders
    above 1 take in the boundaries; a word that is shorter than the order even so has one, its whole."""
    edge = int(order > 1)
    begin, sizes = x.starts[which] - edge, x.ends[which] - x.starts[which] + 2 * edge
    counts = np.maximum(sizes - order + 1, 1)
    at = _spread(begin, counts)
    end = np.repeat(begin + sizes, counts)
    h = np.full(len(at), order, np.uint64)
    for j in range(order):
        inside = at + j < end
        h = W.mix(h * W.GOLDEN + np.where(inside, x.points[np.minimum(at + j, len(x.points) - 1)] + np.uint64(1), np.uint64(0)))
    return h, counts


def _lookup(keys: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.searchsorted(keys, hashes)
    place[place == len(keys)] = 0
    return place, (keys[place] == hashes) if len(keys) else np.zeros(len(hashes), bool)


def scores(model: Model, texts: list[str]) -> np.ndarray:
    """Mean log-likelihood per word of every text in every language, with the number of words last."""
    x = letters(texts)
    n, langs = len(x.starts), len(model.languages)
    words = np.zeros((n, langs), np.float32)
    place, known = _lookup(model.keys[0], word_hashes(x))
    words[known] = model.logs[0][place[known]]
    left = np.flatnonzero(~known)
    for order in ORDERS:
        if not len(left) or not len(model.keys[order]):
            continue
        hashes, counts = gram_hashes(x, left, order)
        place, hit = _lookup(model.keys[order], hashes)
        found = np.concatenate([[0], np.cumsum(hit)])
        ends = np.cumsum(counts)
        first, last = found[ends - counts], found[ends]
        some = last > first
        logs = model.logs[order][place[hit]]
        sums = np.concatenate([np.zeros((1, langs)), np.cumsum(logs, axis=0, dtype=np.float64)])
        words[left[some]] = ((sums[last[some]] - sums[first[some]]) / (last[some] - first[some])[:, None]).astype(np.float32)
        left = left[~some]
    sums = np.concatenate([np.zeros((1, langs)), np.cumsum(words, axis=0, dtype=np.float64)])
    size = np.diff(x.rows)
    return np.c_[(sums[x.rows[1:]] - sums[x.rows[:-1]]) / np.maximum(size, 1)[:, None], size]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and n-grams, added up for each language of a slice."""
    for whole in batches:
        for lo, hi in W.slices(whole.column("text")):
            langs = np.array(whole.column("lang").slice(lo, hi - lo).to_pylist(), object)
            texts = whole.column("text").slice(lo, hi - lo).to_pylist()
            for lang in sorted(set(langs)):
                x = letters([t for t, g in zip(texts, langs) if g == lang])
                every = np.arange(len(x.starts))
                for order in (0, *ORDERS):
                    hashes = gram_hashes(x, every, order)[0] if order else word_hashes(x)
                    keys, count = np.unique(hashes, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(keys), pa.string()), pa.array(np.full(len(keys), order, np.int32)),
                         pa.array(keys.view(np.int64)), pa.array(count.astype(np.int64))], names=["lang", "size", "key", "n"])


def fit(labelled: DataFrame, rows: int = TRAIN_ROWS, entries: int = ENTRIES) -> Model:
    """Learn from (doc_id, text, lang); rows without text or lang are left out."""
    known = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    empty = np.zeros(0, np.uint64)
    if not languages:
        return Model([], {o: empty for o in (0, *ORDERS)}, {o: np.zeros((0, 0), np.float32) for o in (0, *ORDERS)})
    # Hashes are uniform, so this threshold passes about ``rows`` of a language, or all if it has fewer.
    limits = labelled.sparkSession.createDataFrame(
        [(g, (1 << 63) - 1 if n <= rows else -(1 << 63) + rows * (1 << 64) // n) for g, n in sizes.items()], "lang string, most long")
    sample = known.withColumn("place", F.xxhash64(F.col("doc_id").cast("string"))).join(
        F.broadcast(limits), "lang").where(F.col("place") <= F.col("most")).select("lang", "text")
    counts = sample.mapInArrow(_counts, "lang string, size int, key long, n long").groupBy("lang", "size", "key").agg(F.sum("n").alias("n"))
    scratch = Scratch(labelled.sparkSession, "language")
    counts = scratch.table(counts, "counts")  # read three times below
    share = {o: max(50, int(entries * p / len(languages))) for o, p in PARTS.items()}
    best = Window.partitionBy("lang", "size").orderBy(F.desc("n"), "key")
    keep = F.coalesce(*(F.when(F.col("size") == o, F.lit(s)) for o, s in share.items()))
    chosen = (counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep).select("size", "key").distinct())
    totals = {(r["lang"], r["size"]): r["n"] for r in counts.groupBy("lang", "size").agg(F.sum("n").alias("n")).collect()}
    got = counts.join(chosen, ["size", "key"], "left_semi").select("lang", "size", "key", "n").toArrow()
    scratch.drop("counts")
    number = {g: i for i, g in enumerate(languages)}
    lang = np.array([number[g] for g in got["lang"].to_pylist()], np.int64)
    size, key, n = (got[c].to_numpy() for c in ("size", "key", "n"))
    keys, logs = {}, {}
    for order in (0, *ORDERS):
        mine = size == order
        uniq, inverse = np.unique(key[mine].view(np.uint64), return_inverse=True)
        table = np.zeros((len(uniq), len(languages)))
        table[inverse, lang[mine]] = n[mine]
        total = np.array([totals.get((g, order), 0) for g in languages], float)
        keys[order], logs[order] = uniq, np.log((table + SMOOTH) / (total + SMOOTH * (len(uniq) + 1))).astype(np.float32)
    return Model(languages, keys, logs)


def predict(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score, the probability of that language (0 to 1) at the mean evidence
    of a word, taken as many times as there are words, EVIDENCE at most. A null text, and one without a
    letter, is ``und`` with score 0; so is every text if no language was learnt. Equal scores go to the
    language that comes first in order. Columns of these two names are replaced, others pass through."""
    held = spark.sparkContext.broadcast(tuple(model))

    @F.arrow_udf("lang_pred string, score double")
    def guess(texts: pa.Array) -> pa.Array:
        m = Model(*held.value)
        names, values = [UNKNOWN] * len(texts), np.zeros(len(texts))
        for lo, hi in W.slices(texts) if m.languages else ():
            s = scores(m, [t or "" for t in texts.slice(lo, hi - lo).to_pylist()])
            size, s = s[:, -1], s[:, :-1]
            p = np.exp((s - s.max(axis=1, keepdims=True)) * np.minimum(size, EVIDENCE)[:, None])
            best = s.argmax(axis=1)
            for i in np.flatnonzero(size).tolist():
                names[lo + i], values[lo + i] = m.languages[best[i]], p[i, best[i]] / p[i].sum()
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(values)], names=["lang_pred", "score"])

    own = next(f"guess_{i}" for i in range(len(docs.columns) + 1) if f"guess_{i}" not in docs.columns)
    return docs.withColumn(own, guess(F.col("text").cast("string"))).withColumns(
        {"lang_pred": F.col(own)["lang_pred"], "score": F.col(own)["score"]}).drop(own)
