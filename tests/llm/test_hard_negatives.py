import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfrank.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(rows, divisor, positives=5, negatives=3, low=50, high=95):
    use = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        key = (label, [float(np.float32(x)) for x in v])
        use[i] = min(use.get(i, key), key)
    scaled = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in use.items()}
    out = []
    for a in (i for i in scaled if i % divisor == 0):
        label, v = scaled[a]
        scores = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in scaled.items() if i != a}
        first = sorted((i for i in scores if scaled[i][0] == label), key=lambda i: (-scores[i], i))[:positives]
        for p in first:
            fit = [i for i in scores if scaled[i][0] != label and low * scores[p] <= 100 * scores[i] <= high * scores[p]]
            for rank, n in enumerate(sorted(fit, key=lambda i: (-scores[i], i))[:negatives], 1):
                out.append((a, p, rank, n, scores[p], scores[n]))
    return sorted(out)


def check(spark, rows, divisor=5, partitions=3, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions).withColumns({c: F.lit("x") for c in ("row", "cell", "kind", "slot", "scores", "block")})
    got = H.mine(spark, df, F.col("vec_id") % divisor == 0, **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows, divisor, **more)
    assert sorted(tuple(r) for r in got.collect()) == want
    return want


def vectors(n, size=6, labels=3, seed=1, step=0.1):
    rnd = random.Random(seed)
    return [(i, rnd.randrange(labels), [round(rnd.uniform(-0.4, 1) / step) * step for _ in range(size)]) for i in range(n)]


@pytest.mark.parametrize("block,stripe", [(16_384, 65_536), (7, 20)])
def test_ties_and_block_sizes(spark, monkeypatch, block, stripe):
    monkeypatch.setattr(H, "ANCHOR_BLOCK", block)
    monkeypatch.setattr(H, "STRIPE", stripe)
    rows = vectors(160, step=0.5) + [(1000 + i, i % 3, [1.0, 0.5, 0.0, 0.5, 1.0, 0.5]) for i in range(60)]  # many equal scores
    assert len(check(spark, rows)) > 100


def test_hot_label_and_few_positives(spark):
    rows = vectors(200, seed=4)
    rows = [(i, 0 if i % 3 else label, v) for i, label, v in rows] + [(500, 77, [1.0] * 6), (505, 78, [0.9] * 6), (507, 78, [0.5] * 6)]
    check(spark, rows, positives=2, negatives=4, low=10, high=80)


def test_negative_scores_and_windows_without_rows(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [-1.0, 0.0]), (2, 2, [-0.7, 0.0]), (3, 2, [0.0, 1.0]), (5, 1, [0.0, 1.0]), (6, 2, [0.0, 0.0])]
    check(spark, rows)


def test_odd_rows(spark):
    rows = vectors(30) + [(None, 1, [1.0] * 6), (31, None, [1.0] * 6), (32, 1, None), (33, 1, [1.0, None]), (34, 1, [math.nan]), (35, 0, [math.inf]),
                          (40, 1, []), (45, 2, [0.5, 0.5]), (46, 1, [0.5] * 9), (5, 2, [0.5] * 6), (5, 1, [0.25] * 6), (10, 1, [0.25] * 6), (10, 1, [0.25] * 6)]
    check(spark, rows)


def test_empty_tables(spark):
    assert check(spark, []) == []
    assert check(spark, [(1, 1, [1.0]), (2, 1, [1.0])]) == []


def test_scores_that_doubles_cannot_hold(spark):
    with pytest.raises(Exception, match="2\\^53"):
        H.mine(spark, spark.createDataFrame([(0, 1, [1e12]), (1, 1, [1e12])], SCHEMA), F.col("vec_id") == 0).collect()


def test_windows_are_suffixes_of_slots():
    best = H.Best(2, 3)
    best.add(np.array([0, 0, 1, 0, 0]), np.array([5.0, 5.0, 1.0, 9.0, 2.0]), np.array([8, 3, 4, 6, 1]))
    best.add(np.array([0, 1]), np.array([5.0, 7.0]), np.array([1, 9]))
    key, scores, ids = best.rows()
    assert list(zip(key.tolist(), scores.tolist(), ids.tolist())) == [(0, 9, 6), (0, 5, 1), (0, 5, 3), (1, 7, 9), (1, 1, 4)]
