"""Pruned scoring: the same rows as scoring everything, with most (user, block) pairs left out."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfrank.operators import recommend


def tables(spark, n_users=60, n_items=400, k=4, seed=5, spread=2.0):
    """Factors whose norms fall steeply; some are equal, some zero."""
    rng = np.random.default_rng(seed)
    W = rng.random((n_users, k)).round(3)
    H = (rng.random((n_items, k)) * np.exp(-spread * rng.random(n_items) * 4)[:, None]).round(4)
    W[3], H[5:9], H[20:40] = 0, 0, H[20]
    uf = spark.createDataFrame([(u, W[u].tolist()) for u in range(n_users)], "user_id long, factors array<double>")
    itf = spark.createDataFrame([(p, H[p].tolist()) for p in range(n_items)], "product_id long, factors array<double>")
    pairs = [(u, p) for u in range(n_users) for p in np.argsort(-H @ W[u])[:u % 7].tolist()] + [(1, 10 ** 9)]
    pairs += [(59, p) for p in range(n_items - 3)]  # has seen all but three
    return W, H, uf, itf, set(pairs), spark.createDataFrame(pairs, "user_id long, product_id long")


def best(W, H, pairs, n):
    out = set()
    for u in range(len(W)):
        open_ = sorted((p for p in range(len(H)) if (u, p) not in pairs), key=lambda p: (-float(W[u] @ H[p]), p))
        out |= {(u, rank + 1, p) for rank, p in enumerate(open_[:n])}
    return out


@pytest.mark.parametrize("user_block,item_block", [(1000, 1000), (25, 40), (7, 13), (1000, 100)])
def test_equal_to_scoring_everything(spark, user_block, item_block):
    W, H, uf, itf, pairs, seen = tables(spark)
    got = recommend.score_top_n(uf, itf, seen, 4, 5, user_block=user_block, item_block=item_block).collect()
    scores = {(r.user_id, r.product_id): r.score for r in got}
    want = best(W, H, pairs, 5)
    # Equal scores may differ in the last bit between matrix products of different shapes.
    assert len(got) == len(want) and all(math.isclose(s, W[u] @ H[p], rel_tol=1e-12, abs_tol=1e-15) for (u, p), s in scores.items())
    for u, rank, p in want - {(r.user_id, r.rec_rank, r.product_id) for r in got}:
        other = next(r for r in got if r.user_id == u and r.rec_rank == rank)
        assert math.isclose(other.score, W[u] @ H[p], rel_tol=1e-12)


def test_most_pairs_are_skipped(spark):
    W, H, uf, itf, pairs, seen = tables(spark)
    items, tops = recommend.norm_blocks(spark, itf, 20)
    sizes = {r["ib"]: r["count"] for r in items.groupBy("ib").count().collect()}
    assert sum(sizes.values()) == 400 and max(sizes) == len(tops) - 1 and tops == sorted(tops, reverse=True)
    norms = {r["ib"]: r["m"] for r in items.groupBy("ib").agg(F.max(recommend._norm()).alias("m")).collect()}
    assert all(norms[b] <= tops[b] for b in norms)
    head = items.filter("ib = 0").withColumn("ub", F.lit(0))
    users = uf.withColumn("ub", F.lit(0)).withColumn("ib", F.lit(0))
    first = recommend._scored(users, head, recommend._seen_lists(seen, items), 5)
    reach = {r["user_id"]: r["reach"] for r in recommend.bounds(first, uf, tops, 5).collect()}
    assert reach[3] == len(tops) and reach[59] == len(tops)  # a zero user, and one without a bound
    skipped = sum(len(tops) - r for r in reach.values())
    assert skipped > 0.5 * len(W) * len(tops)


def test_equal_norms_are_split_and_odd_norms_are_never_skipped(spark):
    rows = [(p, [1.0, 0.0]) for p in range(90)] + [(90, [0.0, 0.0]), (91, [1e-300, 0.0]), (92, [1e200, 1e200])]
    items, tops = recommend.norm_blocks(spark, spark.createDataFrame(rows, "product_id long, factors array<double>"), 10)
    assert tops[0] == math.inf and len(tops) >= 10
    assert max(r["count"] for r in items.groupBy("ib").count().collect()) < 30
    uf = spark.createDataFrame([(1, [1.0, 0.0]), (2, [-1.0, 0.0])], "user_id long, factors array<double>")
    none = spark.createDataFrame([], "user_id long, product_id long")
    plain = spark.createDataFrame(rows[:-1], "product_id long, factors array<double>")
    got = {(r.user_id, r.product_id) for r in recommend.score_top_n(uf, plain, none, 2, 3, 10, 10).collect()}
    assert got == {(1, 0), (1, 1), (1, 2), (2, 90), (2, 91), (2, 0)}


def test_no_items_or_users(spark):
    none = spark.createDataFrame([], "user_id long, product_id long")
    uf = spark.createDataFrame([(1, [1.0])], "user_id long, factors array<double>")
    itf = spark.createDataFrame([], "product_id long, factors array<double>")
    assert recommend.score_top_n(uf, itf, none, 1, 3, 1, 1).count() == 0
    items = spark.createDataFrame([(p, [float(p)]) for p in range(9)], "product_id long, factors array<double>")
    assert recommend.score_top_n(uf.filter("user_id = 2"), items, none, 1, 3, 2, 2).count() == 0
