import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfrank.llm import quality as Q

SYLLABLES = ["th", "on", "er", "ing", "tion", "re", "an", "ed", "es", "ou", "ble", "st"]


def word(rnd):
    return "".join(rnd.choices(SYLLABLES, k=rnd.randrange(1, 4)))


def corpus(n, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words = [word(rnd) for _ in range(rnd.randrange(20, 120))]
        bad = i % 5 == 0
        if bad:
            style = rnd.randrange(3)
            words = [w + "$$$" for w in words] if style == 0 else [w.upper() + "!!" for w in words] if style == 1 else [w for w in words[:6] for _ in range(15)]
        rows.append((i, " ".join(words), int(not bad)))
    return rows


def test_held_out_accuracy(spark, docs):
    rows = corpus(600)
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows], "doc_id long, quality int, toxic int")
    frame = docs([(i, t) for i, t, _ in rows], extra=True).drop("score")
    model = Q.fit(frame, labels, "quality")
    got = Q.score(spark, frame, model).select("doc_id", "score", "predicted", Q.held_out().alias("held")).collect()
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r.held]
    assert 80 < len(held) < 160 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95


def test_held_out_rows_teach_nothing(spark, docs):
    rows = corpus(200)
    frame = docs([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    turned = labels.withColumn("quality", F.when(Q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = Q.fit(frame, labels, "quality"), Q.fit(frame, turned, "quality")
    assert (a[0] == b[0]).all() and a[1] == b[1]


def test_scores_equal_a_plain_dot_product():
    texts = ["The the THE %%% 42 Été", "", "a", "x!! y!! z!!", "w " * 30_000, "one two three four"]
    rnd = np.random.default_rng(1)
    weights, bias = rnd.normal(size=1 << 10).astype(np.float32), -0.3
    got = Q.dots(pa.array(texts), weights, bias)
    for text, s in zip(texts, got):
        index, _ = Q.ngrams(pa.array([text]), 10)
        z = bias + Q.SCALE * sum(float(weights[i]) for i in index) / max(1, len(index))
        assert math.isclose(s, 1 / (1 + math.exp(-z)), rel_tol=1e-4)


def test_ngrams_do_not_cross_rows():
    both, rows = Q.ngrams(pa.array(["a b c", "d e"]))
    assert both[:rows[1]].tolist() == Q.ngrams(pa.array(["a b c"]))[0].tolist()
    assert both[rows[1]:].tolist() == Q.ngrams(pa.array(["d e"]))[0].tolist()


def test_ftrl_follows_its_definition():
    """Against the update rule written out for dense vectors."""
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(40, 3))
    y = (x[:, 0] > 0).astype(float)
    w, b = Q.ftrl([(np.arange(3), v, t) for v, t in zip(x, y)], 3, epochs=2)
    z, n = np.zeros(4), np.zeros(4)
    l1 = np.array([Q.L1, Q.L1, Q.L1, 0])

    def weights():
        return np.array([0 if abs(z[i]) <= l1[i] else -(z[i] - np.sign(z[i]) * l1[i]) / ((Q.BETA + n[i] ** 0.5) / Q.ALPHA + Q.L2) for i in range(4)])
    for _ in range(2):
        for v, t in zip(x, y):
            v, now = np.append(v, 1), weights()
            g = (1 / (1 + np.exp(-now @ v)) - t) * v
            for i in range(4):
                z[i] += g[i] - ((n[i] + g[i] ** 2) ** 0.5 - n[i] ** 0.5) / Q.ALPHA * now[i]
                n[i] += g[i] ** 2
    assert np.allclose(np.append(w, b), weights())


def test_nulls_ties_and_empty_tables(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    frame = docs([(1, None), (2, ""), (None, "x"), (3, "y"), (3, "y")])
    got = Q.score(spark, frame, Q.fit(frame, none, "quality")).collect()
    assert [r.score for r in got] == [0.5] * 5
    odd = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1), (3, 7), (2, 1), (2, 1), (99, 0)], "doc_id long, quality int")
    got = Q.score(spark, frame, Q.fit(frame, odd, "quality")).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert Q.score(spark, docs([]), Q.fit(docs([]), odd, "quality")).collect() == []


def test_sample_is_bounded(spark, docs):
    rows = corpus(100)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    frame = docs([(i, t) for i, t, _ in rows] * 2)
    assert Q.sample(frame, labels, "quality", {0: 50, 1: 50}, 30).count() == 30
