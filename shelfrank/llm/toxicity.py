"""Toxicity by compression distance: windows of a text are compressed with a zstandard dictionary of
ordinary text and with one that also knows toxic text; a toxic window gets shorter with the second.

Training, on a bounded sample of labelled rows:

* ordinary dictionary: trained by zstandard on windows of ordinary documents;
* toxic dictionary: trained by zstandard on what toxic documents say beyond ordinary ones, that is on
  their words that significantly more toxic than ordinary documents hold; chosen words that the trainer
  leaves out are added, so it holds all. It is compressed with in front of the ordinary one, so ordinary
  windows come out alike under both;
* thresholds: on sample rows that no dictionary was trained on, the gains of a document's windows are
  calibrated by a logistic regression, weighted back to the classes' shares in the sample's source.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm import words as W
from shelfrank.llm.quality import marks, sample
from shelfrank.llm.tables import Scratch

#: Labelled rows of each class that are learnt from at most, those with the smallest hashed doc_id.
TOXIC_ROWS, ORDINARY_ROWS = 4_000, 8_000
#: Characters of a window; it ends at a space where one is near.
WINDOW = 80
ORDINARY_BYTES, TOXIC_BYTES = 16_384, 6_144
#: Toxic words: in so many toxic documents at least, whatever their number, so many times more often than in
#: ordinary ones, and with this log-likelihood ratio (G2, p = 1e-5) against equal shares; MOST_WORDS at most, by documents.
MIN_DOCS, MIN_LIFT, MIN_G2, MOST_WORDS = 3, 30.0, 19.51, 5_000
#: Bytes of one document that dictionaries are trained on at most, spread over the whole document.
SAMPLE_BYTES = 4_096
THRESHOLD = 0.5
#: Gains from these bytes on are counted.
STEPS = (3, 4, 5)
MARKS = ".,;:!?"


class Model(NamedTuple):
    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the bias


def plain(text: str) -> str:
    return " ".join(text.lower().split())


def windows(text: str, size: int = WINDOW) -> list[str]:
    """Consecutive windows of the whole text, cut at the last space of a window's second half if any."""
    out, at, n = [], 0, len(text)
    while at < n:
        end = at + size
        if end < n:
            space = text.rfind(" ", at + size // 2, end)
            end = space if space > 0 else end
        out.append(text[at:end])
        at = end
    return out


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Raw-content dictionary; lazy matching over the whole of it, no frame extras. The tables have room for
    every place of the dictionary: in smaller ones its end would push out its start, the toxic part."""
    log = max(17, (len(content) + 4 * WINDOW).bit_length())
    params = zstandard.ZstdCompressionParameters(
        window_log=log, hash_log=log, chain_log=log, search_log=6, min_match=4, target_length=16, strategy=zstandard.STRATEGY_LAZY2,
        write_content_size=0, write_checksum=0, write_dict_id=0)
    known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=params)


def gains(text: str, ordinary: zstandard.ZstdCompressor, toxic: zstandard.ZstdCompressor) -> np.ndarray:
    """Bytes that the toxic dictionary saves, for every window of the text."""
    parts = [w.encode("utf-8", "surrogatepass") for w in windows(plain(text))]
    a = [len(ordinary.compress(p)) for p in parts]
    b = [len(toxic.compress(p)) for p in parts]
    return np.array(a, float) - np.array(b, float)


def features(gain: np.ndarray) -> list[float]:
    n = len(gain)
    if not n:
        return [0.0] * (5 + 2 * len(STEPS))
    g = np.sort(gain)[::-1]
    counts = [int((g >= s).sum()) for s in STEPS]
    return [g[0], g[:2].mean(), g[:4].mean(), g.mean(), *(c / n for c in counts), *(np.log1p(c) for c in counts), np.log(n)]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.5, steps: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean and scale of the features, and weights (bias last), by Newton steps."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.c_[(x - mean) / scale, np.ones(len(x))]
    b = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(penalty), a.T @ (weight * (p - y)) + penalty * b)
        b -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, b


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of every text."""
    for batch in batches:
        found = [sorted({w.strip(MARKS) for w in plain(t).split()}) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.list_(pa.string()))], names=["label", "words"])


def _samples(chosen: set[str]):
    """What dictionaries are trained on: a toxic text's chosen words in order, windows of an ordinary one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                if label:
                    parts = [w for w in (w.strip(MARKS) for w in plain(text).split()) if w in chosen]
                else:
                    parts = windows(plain(text), 256)
                size = max(1, sum(len(p) + 1 for p in parts))
                step = -(-size // SAMPLE_BYTES)
                out.append(" ".join(parts[::step]).encode("utf-8", "surrogatepass")[:SAMPLE_BYTES])
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(out, pa.binary())], names=["label", "sample"])
    return run


def _train(frame: pd.DataFrame) -> pd.DataFrame:
    """Both dictionaries; an empty one where there is too little to train on."""
    def trained(samples: list[bytes], size: int, piece: int, k: int) -> bytes:
        parts = sorted(s[i:i + piece] for s in samples for i in range(0, len(s), piece))
        try:
            return zstandard.train_dictionary(size, parts, k=k, d=6).as_bytes()
        except zstandard.ZstdError:
            return b"".join(dict.fromkeys(parts))[:size]

    return pd.DataFrame({"ordinary": [trained(list(frame["sample"][frame.label == 0]), ORDINARY_BYTES, 256, 64)],
                         "toxic": [trained(list(frame["sample"][frame.label == 1]), TOXIC_BYTES, 128, 32)]})


def _features(ordinary: bytes, toxic: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = compressor(ordinary), compressor(toxic + ordinary)
        for batch in batches:
            rows = [features(gains(t, a, b)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(rows, pa.list_(pa.float64()))], names=["label", "x"])
    return run


def fit(docs: DataFrame, labels: DataFrame, label: str, toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS) -> Model:
    """Learn ``label`` (1 for toxic, 0 for ordinary; other rows are left out) from the texts of docs
    (doc_id, text) that labels (doc_id, label) names and that are not held out, a bounded number of each;
    rows without text are left out, and of equal texts one counts. Without rows of both classes every
    score is the share of toxic labels (0.0 without any)."""
    counts = {r["label"]: r["count"] for r in marks(labels, label).groupBy("label").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    if len(counts) < 2:
        return Model(b"", b"", np.zeros(1), np.ones(1), np.array([0.0, np.log(max(share, 1e-6) / max(1 - share, 1e-6))]))
    rows = sample(docs, labels, label, {1: toxic_rows, 0: ordinary_rows}, toxic_rows + ordinary_rows)
    known = rows.where(F.col("text").isNotNull()).groupBy("text", "label").agg(F.min("place").alias("place")).withColumn(
        "role", F.pmod(F.xxhash64("place"), F.lit(3)) == 0)  # a third is for calibration
    chosen_rows = Scratch(docs.sparkSession, "toxicity").table(known, "sample")
    return _fit(chosen_rows, share)


def significance(toxic: Column, ordinary: Column, n1: int, n0: int) -> Column:
    """G2 of a word in so many of n1 toxic and n0 ordinary documents against equal shares of both."""
    def part(count: Column, n: int) -> Column:
        return F.when(count > 0, count * F.log(count * (n1 + n0) / ((toxic + ordinary) * max(1, n)))).otherwise(0.0)
    return 2 * (part(toxic, n1) + part(ordinary, n0))


def with_all(trained: bytes, words: list[str]) -> bytes:
    """A dictionary that holds every word: those that the trained one lacks go in front of it."""
    parts = [w[:WINDOW].encode("utf-8", "surrogatepass") for w in words]
    return b"".join(b" " + p for p in dict.fromkeys(parts) if p not in trained) + trained


def _fit(rows: DataFrame, share: float) -> Model:
    train = rows.where(~F.col("role")).select("label", "text")
    sizes = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    chosen = (train.mapInArrow(_words, "label int, words array<string>").select("label", F.explode("words").alias("word"))
              .groupBy("word").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("ordinary"))
              .where((F.col("toxic") >= MIN_DOCS) & (F.col("toxic") / max(1, n1) >= MIN_LIFT * F.col("ordinary") / max(1, n0))
                     & (significance(F.col("toxic"), F.col("ordinary"), n1, n0) >= MIN_G2))
              .orderBy(F.desc("toxic"), "word").limit(MOST_WORDS).collect())
    words = [r["word"] for r in chosen if r["word"]]
    samples = train.mapInArrow(_samples(set(words)), "label int, sample binary")
    got = samples.groupBy(F.lit(0).alias("all")).applyInPandas(_train, "ordinary binary, toxic binary").collect()
    ordinary, toxic = (bytes(got[0]["ordinary"]), bytes(got[0]["toxic"])) if got else (b"", b"")
    toxic = with_all(toxic, words)
    held = rows.where("role").select("label", "text").mapInArrow(_features(ordinary, toxic), "label int, x array<double>").collect()
    y = np.array([r["label"] for r in held], float)
    if not 0 < y.sum() < len(y):
        return Model(b"", b"", np.zeros(1), np.ones(1), np.array([0.0, np.log(share / (1 - share))]))
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return Model(ordinary, toxic, *logistic(np.array([r["x"] for r in held]), y, weight))


def score(spark: SparkSession, docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (0 to 1, higher: toxic likelier) and predicted (1 if score >= threshold), from
    all windows of the whole text. A null or blank text has no windows; its features are zeros."""
    held = spark.sparkContext.broadcast(tuple(model))

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        m = Model(*held.value)
        if len(m.mean) == 1:
            return pa.array(np.full(len(texts), 1 / (1 + np.exp(-m.weights[-1]))))
        a, b = compressor(m.ordinary), compressor(m.toxic + m.ordinary)
        x = np.array([features(gains(t or "", a, b)) for lo, hi in W.slices(texts) for t in texts.slice(lo, hi - lo).to_pylist()])
        z = ((x - m.mean) / m.scale) @ m.weights[:-1] + m.weights[-1]
        return pa.array(1 / (1 + np.exp(-np.clip(z, -35, 35))))

    return docs.withColumn("score", scores(F.col("text").cast("string"))).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
