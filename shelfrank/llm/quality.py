"""Quality classifier: logistic regression over hashed word n-grams, trained with FTRL-Proximal.

Tokens are runs of letters, runs of digits and runs of other marks. Every token counts as itself
(letters lower-cased) and by its form: the case of its letters, whether it repeats the word before,
a mark as it stands. N-grams of both kinds are hashed to ``2 ** HASH_BITS`` weights; a document's
features are its n-gram frequencies. A score is the sigmoid of one sparse dot product.

The weights come from follow-the-regularised-leader updates (McMahan et al., "Ad Click Prediction: a
View from the Trenches", 2013) over a bounded sample of labelled rows, in a fixed order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm import words as W

HASH_BITS = 18
#: Labelled rows that are learnt from at most, those with the smallest hashed doc_id; it bounds the one
#: training task (a row has at most 2 ** HASH_BITS features).
TRAIN_ROWS = 6_000
#: Passes over the rows: EPOCHS, or as many as make UPDATES updates of few rows, MOST_EPOCHS at most.
EPOCHS, UPDATES, MOST_EPOCHS = 4, 16_000, 60
#: FTRL-Proximal: learning rate, its smoothing, L1 and L2.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.05, 0.05
#: Feature values are SCALE * frequency, so a text that consists of one n-gram has the value SCALE.
SCALE = 4.0
THRESHOLD = 0.3

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_KIND = np.where(W.SPACED, 3, 0)  # 0 space, 1 letters, 2 digits, 3 marks
_KIND[_LETTER], _KIND[_DIGIT] = 1, 2
_KIND = _KIND.astype(np.uint8)
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the tokens as themselves and by form, and row bounds."""
    data, offsets = W.flat(column)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    kind = _KIND[data]
    change = np.ones(len(data), bool)
    change[1:] = kind[1:] != kind[:-1]
    change[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(data))
    solid = kind[starts] > 0
    starts, ends = starts[solid], ends[solid]
    rows = np.searchsorted(starts, offsets)
    kinds = kind[starts]
    own = W.hash_ranges(W._LOWER[data], starts, ends)
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    capitals = upper[ends] - upper[starts]
    case = np.where(capitals == 0, 1, np.where((capitals == 1) & _UPPER[data[starts]], 2, np.where(capitals == ends - starts, 3, 4)))
    form = np.where(kinds == 3, own, (kinds * np.uint64(16) + case.astype(np.uint64)))
    again = np.zeros(len(own), bool)
    again[1:] = own[1:] == own[:-1]
    again[rows[:-1][rows[:-1] < len(own)]] = False
    form = np.where(again & (kinds == 1), np.uint64(9), form)
    return own, form, rows


def ngrams(column: pa.Array, bits: int = HASH_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Weight numbers of all n-grams of every text, one token after another, and row bounds:
    one and two tokens as themselves, one to three by form."""
    own, form, rows = tokens(column)
    n = len(own)
    kinds = ((own, 2, 0x51), (form, 3, 0xF0))
    out = np.full((n, 5), -1, np.int64)
    first = np.repeat(rows[:-1], np.diff(rows))  # first token of each token's row
    at, col = np.arange(n), 0
    for hashes, most, seed in kinds:
        h = np.full(n, seed, np.uint64)
        for back in range(most):
            before = np.concatenate([np.zeros(back, np.uint64), hashes[:n - back]]) if back <= n else np.zeros(n, np.uint64)
            h = W.mix(h * W.GOLDEN + before + np.uint64(back + 1))
            out[:, col] = np.where(at - back >= first, (h >> np.uint64(64 - bits)).astype(np.int64), -1)
            col += 1
    keep = out >= 0
    return out[keep], np.concatenate([[0], np.cumsum(keep.sum(axis=1))])[rows]


def dots(column: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """Scores of all texts, 0 to 1; an empty text has the score of the bias."""
    out = []
    for a, b in W.slices(column):
        index, rows = ngrams(column.slice(a, b - a), int(len(weights)).bit_length() - 1)
        sums = np.concatenate([[0.0], np.cumsum(weights[index], dtype=np.float64)])
        size = np.diff(rows)
        out.append(bias + SCALE * (sums[rows[1:]] - sums[rows[:-1]]) / np.maximum(size, 1))
    z = np.concatenate(out) if out else np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, float]], dim: int, epochs: int | None = None, alpha: float = ALPHA,
         beta: float = BETA, l1: float = L1, l2: float = L2) -> tuple[np.ndarray, float]:
    """Weights and bias after FTRL-Proximal passes over (feature numbers, values, label) examples.
    The bias is one more coordinate, without L1."""
    z, g2 = np.zeros(dim + 1), np.zeros(dim + 1)
    penalty = np.full(dim + 1, l1)
    penalty[dim] = 0

    def weight(i):
        return np.where(np.abs(z[i]) <= penalty[i], 0.0, (np.sign(z[i]) * penalty[i] - z[i]) / ((beta + np.sqrt(g2[i])) / alpha + l2))

    if epochs is None:
        epochs = min(MOST_EPOCHS, max(EPOCHS, -(-UPDATES // max(1, len(examples)))))
    for _ in range(epochs):
        for index, value, label in examples:
            i, x = np.append(index, dim), np.append(value, 1.0)
            w = weight(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - label) * x
            sigma = (np.sqrt(g2[i] + g * g) - np.sqrt(g2[i])) / alpha
            z[i] += g - sigma * w
            g2[i] += g * g
    w = weight(np.arange(dim + 1))
    return w[:dim], float(w[dim])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        index, rows = ngrams(batch.column("text"))
        blobs = []
        for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
            number, count = np.unique(index[a:b], return_counts=True)
            blobs.append((number.astype("<i4").tobytes(), (SCALE * count / max(1, b - a)).astype("<f4").tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("place"), batch.column("label"), pa.array([x[0] for x in blobs], pa.binary()), pa.array([x[1] for x in blobs], pa.binary())],
            names=["place", "label", "numbers", "vals"])


def _train(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["place", "numbers", "vals", "label"])
    examples = [(np.frombuffer(a, "<i4"), np.frombuffer(b, "<f4"), float(y))
                for a, b, y in zip(frame.numbers, frame.vals, frame.label)]
    weights, bias = ftrl(examples, 1 << HASH_BITS)
    return pd.DataFrame({"weights": [weights.astype("<f4").tobytes()], "bias": [bias]})


def fit(docs: DataFrame, labels: DataFrame, label: str, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Learn ``label`` (0 or 1; other rows are left out) from the texts of docs (doc_id, text) that labels
    (doc_id, label) names and that are not held out; ``sample`` bounds them to ``rows``. Without rows all
    scores are 0.5."""
    made = sample(docs, labels, label, {0: rows, 1: rows}, rows).select(
        "place", "label", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        _examples, "place long, label int, numbers binary, vals binary")
    got = made.groupBy(F.lit(0).alias("all")).applyInPandas(_train, "weights binary, bias double").collect()
    if not got:
        return np.zeros(1 << HASH_BITS, np.float32), 0.0
    return np.frombuffer(got[0]["weights"], "<f4"), got[0]["bias"]


def score(spark: SparkSession, docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (0 to 1, higher: label 1 likelier) and predicted (1 if score >= threshold).
    Null texts score as empty ones."""
    held = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        weights, bias = held.value
        return pa.array(dots(texts, weights, bias))

    return docs.withColumn("score", scores(F.col("text").cast("string"))).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def held_out(doc_id: str = "doc_id", folds: int = 5, fold: int = 0):
    """True for the rows that no model learns from; a row without doc_id is not one of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def marks(labels: DataFrame, label: str) -> DataFrame:
    """Distinct (doc_id, label) of the rows that may be learnt from, with ``place``, the hash that orders them."""
    return (labels.where(~held_out()).select("doc_id", F.col(label).cast("int").alias("label"))
            .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).distinct()
            .withColumn("place", F.xxhash64(F.col("doc_id").cast("string"))))


def sample(docs: DataFrame, labels: DataFrame, label: str, by_label: dict[int, int], rows: int) -> DataFrame:
    """(doc_id, text, label, place) of at most ``rows`` labelled documents, ``by_label`` of each label, by
    place. The labels alone are ordered; only the chosen ids, whose number is bounded, are broadcast to
    the texts. Of rows that share a doc_id one is taken."""
    known = marks(labels, label)
    chosen = None
    for value, most in by_label.items():
        some = known.where(F.col("label") == value).orderBy("place", "doc_id").limit(most)
        chosen = some if chosen is None else chosen.union(some)
    chosen = chosen.orderBy("place", "doc_id", "label").limit(rows)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id", "label"])
