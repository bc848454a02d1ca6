"""Fits that are stopped and resumed, jobs of an iteration, second starts of unused factors."""

import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfrank.operators import factor


def cells(spark, n=14, m=11, rank=3, seed=3):
    rng = np.random.default_rng(seed)
    R = rng.random((n, rank)) @ rng.random((rank, m)) * (rng.random((n, m)) < 0.7)
    rows = [(u, p, float(R[u, p]), bool((u * 7 + p) % 5)) for u in range(n) for p in range(m) if R[u, p] > 0]
    return spark.createDataFrame(rows, "user_id long, product_id long, final_score double, is_train boolean")


def factors(model):
    return ({r["user_id"]: r["factors"] for r in model.user_factors.collect()}, {r["product_id"]: r["factors"] for r in model.item_factors.collect()})


def test_resumed_fit_equals_uninterrupted_one(spark):
    df, args = cells(spark), dict(k=3, tol=0.0)
    whole = factor.fit_nmf(spark, df, max_iter=6, **args)
    run = uuid.uuid4().hex[:8]
    first = factor.fit_nmf(spark, df, max_iter=3, run=run, **args)
    assert first.iterations == 3
    rest = factor.fit_nmf(spark, df, max_iter=6, run=run, **args)
    assert rest.iterations == 6 and rest.losses[:3] == first.losses
    assert np.allclose(rest.losses, whole.losses, rtol=1e-9) and np.isclose(rest.objective, whole.objective)
    for a, b in zip(factors(whole), factors(rest)):
        assert a.keys() == b.keys() and all(np.allclose(a[i], b[i], rtol=1e-7, atol=1e-9) for i in a)
    again = factor.fit_nmf(spark, df, max_iter=6, run=run, **args)  # nothing is left to do
    assert again.iterations == 6 and again.losses == rest.losses
    with pytest.raises(ValueError, match="other parameters"):
        factor.fit_nmf(spark, df, k=4, max_iter=2, run=run)


def test_a_half_step_is_one_job(spark):
    """Its write gives the Grams: no job reads the stored solve for them."""
    df = cells(spark)
    tracker = spark.sparkContext.statusTracker()

    def jobs(n):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, "fit")
        factor.fit_nmf(spark, df, k=3, tol=0.0, max_iter=n)
        found = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(found)

    few, more = jobs(2), jobs(5)
    # A job for each shuffle and broadcast of the adaptive plan, and one for the result: 4 a half step, 8 an iteration.
    assert (more - few) / 3 <= 8


def test_sums_of_the_write_are_the_grams(spark):
    rows = spark.createDataFrame([(u, [float(u), 1.0]) for u in range(30)], "user_id long, b array<double>").repartition(4)
    G = np.array([[2.0, 0.5], [0.5, 1.0]])
    base = f"{factor.checkpoint_dir(spark)}/grams-{uuid.uuid4().hex[:8]}"
    stored, hat, plain, fb = factor._store(spark, factor._solve_side(rows, "user_id", G, 0.1), "user_id", base, 2)
    W = np.array([r["factors"] for r in stored.orderBy("user_id").collect()])
    B = np.array([[float(u), 1.0] for u in range(30)])
    assert np.allclose(hat, W.T @ W) and np.allclose(plain, W.T @ W) and np.isclose(fb, (W * B).sum()) and len(W) == 30


def test_an_unused_factor_gets_a_second_start(spark, monkeypatch):
    """A start with an empty column stalls with two factors where three are needed."""
    df = cells(spark).withColumn("is_train", F.lit(True))
    start = factor.hashed_start

    def with_empty_column(ids, key, k, scale, seed):
        rows = start(ids, key, k, scale, seed)
        return rows.withColumn("factors", F.transform("factors", lambda x, i: F.when(i == 1, 0.0).otherwise(x))) if key == "user_id" else rows
    monkeypatch.setattr(factor, "hashed_start", with_empty_column)
    args = dict(k=3, max_iter=12, tol=0.0, alpha_w=0.0, alpha_h=0.0)
    monkeypatch.setattr(factor, "UNUSED", -1.0)
    stalled = factor.fit_nmf(spark, df, **args)
    monkeypatch.setattr(factor, "UNUSED", 1e-12)
    model = factor.fit_nmf(spark, df, **args)
    assert all(v[1] == 0 for v in factors(stalled)[0].values())
    assert any(v[1] > 0 for v in factors(model)[0].values()) and model.objective < 0.8 * stalled.objective


def test_numbers_are_dense_and_implicit_als_runs(spark):
    df = cells(spark).withColumn("user_id", F.col("user_id") * 1_000_003 + (1 << 40))
    got = sorted(r["u"] for r in factor._numbered(df, "user_id", "u").collect())
    assert got == list(range(len(got))) and len(got) == df.select("user_id").distinct().count()
    _, uf, itf = factor.fit_als(df, k=2, max_iter=2, implicit=True)
    assert uf.count() == df.filter("is_train").select("user_id").distinct().count() and itf.count() > 0
    assert all(x >= 0 for r in uf.collect() for x in r["factors"])


def test_a_small_side_is_summed_over_the_other_sides_table(spark, monkeypatch):
    """Many users, few products: one table, bucketed by user alone; no factor row is copied, and the sums of a user are shuffled
    once for each of its tasks at most, not once for each pair or file."""
    df = cells(spark, n=300, m=11)
    args = dict(k=3, max_iter=4, tol=0.0)
    monkeypatch.setattr(factor, "WIDE", 0)          # both sides joined, in salted tables
    monkeypatch.setattr(factor, "SMALL_SIDE", 0)
    wide = factor.fit_nmf(spark, df, **args)
    monkeypatch.setattr(factor, "WIDE", 100_000)    # both sides joined, without salts
    joined = factor.fit_nmf(spark, df, **args)
    tables, plans, bucketed, store = [], [], factor._bucketed, factor._store

    def seen_table(spark, rows, key, other, buckets, base, salts=factor.SALTS):
        tables.append((key, salts))
        return bucketed(spark, rows, key, other, buckets, base, salts)

    def seen_plan(spark, solved, *rest):
        plans.append(solved._jdf.queryExecution().optimizedPlan().toString())
        return store(spark, solved, *rest)
    monkeypatch.setattr(factor, "_bucketed", seen_table)
    monkeypatch.setattr(factor, "_store", seen_plan)
    monkeypatch.setattr(factor, "SMALL_SIDE", 50)
    few = factor.fit_nmf(spark, df, **args)
    assert tables == [("user_id", 1)] and plans and not any("Generate" in p or "explode" in p for p in plans)
    turned = df.select(F.col("product_id").alias("user_id"), F.col("user_id").alias("product_id"), "final_score", "is_train")
    tables.clear()
    factor.fit_nmf(spark, turned, **args)            # few users, many products
    assert tables == [("product_id", 1)]
    for other in (wide, joined):
        assert np.allclose(few.losses, other.losses, rtol=1e-9)
        for a, b in zip(factors(few), factors(other)):
            assert a.keys() == b.keys() and all(np.allclose(a[i], b[i], rtol=1e-7, atol=1e-9) for i in a)


def test_buckets_grow_with_the_pairs(spark):
    cores = spark.sparkContext.defaultParallelism
    assert factor._buckets(spark, 0) == 1 and factor._buckets(spark, 10 ** 6) <= 10 ** 6 // factor.FEW_PAIRS + 1
    for pairs in (10 ** 7, 10 ** 8, 10 ** 9):
        n = factor._buckets(spark, pairs)
        assert n % cores == 0 and pairs / n <= factor.BUCKET_PAIRS and n <= pairs / factor.BUCKET_PAIRS + cores
    assert factor._buckets(spark, 10 ** 13) == factor.MOST_BUCKETS
