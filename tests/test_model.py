"""Factor model, scoring and evaluation on small inputs."""

import uuid

import numpy as np
from pyspark.sql import functions as F

from conftest import SF01
from shelfrank.operators import evaluate, factor, matrix, recommend
from shelfrank.plans import registry as R


def test_nnls_rows_meets_kkt():
    rng = np.random.default_rng(0)
    A = rng.random((30, 6))
    G = A.T @ A + 0.1 * np.eye(6)
    B = rng.normal(size=(50, 6)) * 3
    W = factor.nnls_rows(G, B, sweeps=500)
    grad = W @ G - B
    assert (W >= 0).all()
    assert np.abs(grad[W > 1e-9]).max() < 1e-6          # stationary on the free variables
    assert grad[W <= 1e-9].min() > -1e-6                  # no descent direction into the bound


def fresh(spark, name):
    return f"{factor.checkpoint_dir(spark)}/shelfrank_nmf_{name}_{uuid.uuid4().hex[:8]}"


def tiny(spark):
    rng = np.random.default_rng(1)
    U, V = rng.random((4, 2)), rng.random((2, 5))
    R_ = U @ V * 5
    rows = [(u, p, float(R_[u, p]), True) for u in range(4) for p in range(5)]
    return spark.createDataFrame(rows, "user_id long, product_id long, final_score double, is_train boolean")


def test_nmf_loss_falls_and_factors_nonnegative(spark):
    m = factor.fit_nmf(spark, tiny(spark), k=2, max_iter=30, alpha_w=0.0, alpha_h=0.0, tol=0.0, extrapolate=False)
    assert all(b <= a + 1e-9 for a, b in zip(m.losses, m.losses[1:]))
    for df in (m.user_factors, m.item_factors):
        assert all(x >= 0 for r in df.collect() for x in r.factors)
    norm = float(np.sqrt(sum(r.final_score ** 2 for r in tiny(spark).collect())))
    # non-convex: a stationary point, not necessarily the exact factorisation; far better than W = 0
    assert m.reconstruction_error < 0.2 * norm


def test_scores_exclude_seen_and_saturated_user(spark):
    uf = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "user_id long, factors array<double>")
    itf = spark.createDataFrame([(p, [float(p), float(10 - p)]) for p in range(1, 8)], "product_id long, factors array<double>")
    seen = spark.createDataFrame([(1, 7), (1, 6)] + [(2, p) for p in range(1, 6)], "user_id long, product_id long")
    got = recommend.score_top_n(uf, itf, seen, k=2, n=5, user_block=1, item_block=3).orderBy("user_id", "rec_rank").collect()
    u1 = [r.product_id for r in got if r.user_id == 1]
    u2 = [r.product_id for r in got if r.user_id == 2]
    assert u1 == [5, 4, 3, 2, 1]          # 7 and 6 seen; highest first
    assert u2 == [6, 7]                   # saturated user: only 2 unseen left (T11)


def test_recommendations_never_seen(spark):
    ent = matrix.train_test_split(matrix.matrix_input(R.user_matrix(spark, SF01)))
    m = factor.fit_nmf(spark, ent, k=4, max_iter=3)
    recs = recommend.recommend_top_n(m.user_factors, m.item_factors, ent, R.clean_catalog(spark, SF01), m.k)
    assert recs.join(ent, ["user_id", "product_id"]).count() == 0
    assert recs.groupBy("user_id").count().filter("count > 5").count() == 0
    met = evaluate.model_metrics(spark, ent, m).first()
    assert met.n_test > 0 and met.rmse >= met.mae >= 0


def test_split_is_repeatable_and_about_80_percent(spark):
    ent = matrix.matrix_input(R.user_matrix(spark, SF01))
    a = matrix.train_test_split(ent)
    b = matrix.train_test_split(ent.repartition(3))
    assert a.exceptAll(b).count() == 0
    frac = a.agg(F.avg(F.col("is_train").cast("double"))).first()[0]
    assert 0.75 < frac < 0.85


def test_extrapolation_not_worse_than_plain(spark):
    ent = matrix.train_test_split(matrix.matrix_input(R.user_matrix(spark, SF01)))
    plain = factor.fit_nmf(spark, ent, k=8, max_iter=8, tol=0.0, extrapolate=False)
    fast = factor.fit_nmf(spark, ent, k=8, max_iter=8, tol=0.0)
    assert fast.objective <= plain.objective * 1.001
    assert all(x >= 0 for r in fast.user_factors.collect() for x in r.factors)


def test_starts_at_cluster_settings(spark):
    """The bucket count stays within Spark's limit however many shuffle partitions a cluster has."""
    from shelfrank.plans.session import cluster_settings
    parts = int(cluster_settings(100e12, 1000, 4)["spark.sql.shuffle.partitions"])
    assert parts > 100_000 >= 2 * factor.MOST_BUCKETS
    before, most = spark.conf.get("spark.sql.shuffle.partitions"), factor.MOST_BUCKETS
    try:
        factor.MOST_BUCKETS = 16  # as many tasks as a test can run
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "8")
        table = factor._bucketed(spark, tiny(spark).withColumnRenamed("final_score", "score").drop("is_train"), "user_id", "product_id",
                                 min(factor.MOST_BUCKETS, parts), fresh(spark, "limits"))
        assert table.count() == 20
    finally:
        factor.MOST_BUCKETS = most
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_product_with_half_of_all_pairs_is_spread(spark):
    import glob
    import os
    n = 40_000
    df = spark.range(n).select((F.col("id") % 7919).alias("user_id"),
                               F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id") % 211).cast("long").alias("product_id"),
                               F.lit(1.0).alias("score"))
    base = fresh(spark, "hot")
    table = factor._bucketed(spark, df, "product_id", "user_id", 8, base)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{base.removeprefix('file:')}/by_product_id/*.parquet")]
    rows = [r["count"] for r in table.groupBy(F.input_file_name()).count().collect()]
    assert len(rows) == 8 and max(rows) < 0.4 * n and sum(rows) == n, (rows, sizes)


def test_als_takes_ids_beyond_32_bits(spark):
    big = tiny(spark).withColumn("user_id", F.col("user_id") + (1 << 40)).withColumn("product_id", F.col("product_id") - (1 << 50))
    _, uf, itf = factor.fit_als(big, k=2, max_iter=2)
    assert {r.user_id for r in uf.collect()} == {(1 << 40) + i for i in range(4)} and itf.count() == 5


def test_scores_do_not_depend_on_blocks(spark):
    rng = np.random.default_rng(3)
    uf = spark.createDataFrame([(u, [float(x) for x in rng.integers(0, 3, 3)]) for u in range(40)], "user_id long, factors array<double>")
    itf = spark.createDataFrame([(p, [float(x) for x in rng.integers(0, 3, 3)]) for p in range(60)], "product_id long, factors array<double>")
    seen = spark.createDataFrame([(u, p) for u in range(40) for p in range(60) if (u + p) % 3 == 0], "user_id long, product_id long")
    W = {r.user_id: np.array(r.factors) for r in uf.collect()}
    H = {r.product_id: np.array(r.factors) for r in itf.collect()}
    want = {(u, rank + 1, p) for u in W for rank, p in enumerate(sorted((p for p in H if (u + p) % 3), key=lambda p: (-W[u] @ H[p], p))[:5])}
    for ub, ib, chunk in ((100, 100, 256), (7, 11, 256), (16, 13, 3)):
        recommend.CHUNK, old = chunk, recommend.CHUNK
        got = recommend.score_top_n(uf, itf, seen, 3, 5, user_block=ub, item_block=ib).collect()
        recommend.CHUNK = old
        assert {(r.user_id, r.rec_rank, r.product_id) for r in got} == want


def stored_triplets(spark, df, name):
    base = fresh(spark, name)
    cells = df.select("user_id", "product_id", F.col("final_score").alias("score"))
    return (factor._bucketed(spark, cells, "user_id", "product_id", 8, base), factor._bucketed(spark, cells, "product_id", "user_id", 8, base), base)


def test_svd_matches_numpy(spark):
    rng = np.random.default_rng(5)
    A = rng.random((60, 8)) @ np.diag([9, 7, 5, 4, 3, 2, 1, 0.5]) @ rng.random((8, 40)) * (rng.random((60, 40)) < 0.7)
    df = spark.createDataFrame([(u, p, float(A[u, p])) for u in range(60) for p in range(40) if A[u, p]],
                               "user_id long, product_id long, final_score double")
    by_user, by_product, base = stored_triplets(spark, df, "svd")
    svd = factor.truncated_svd(spark, by_user, by_product, df.select("product_id").distinct(), 4, base, rounds=6)
    U, s, V = np.linalg.svd(A)
    assert np.allclose(svd.values, s[:4], rtol=1e-3)
    got = np.zeros((60, 4))
    for r in svd.users.collect():
        got[r.user_id] = r.factors
    assert np.allclose(np.abs(got.T @ U[:, :4]).max(axis=1), 1, atol=0.02)
    w, h = factor.svd_start(svd, df.select("user_id").distinct(), df.select("product_id").distinct(), 4, float(A.mean()))
    W = np.array([r.factors for r in w.orderBy("user_id").collect()])
    H = np.array([r.factors for r in h.orderBy("product_id").collect()])
    assert W.shape == (60, 4) and (W > 0).all() and (H > 0).all()
    assert np.allclose(W[:, 0], np.abs(U[:, 0]) * np.sqrt(s[0]), rtol=0.05, atol=0.02)


def test_svd_start_reaches_the_objective(spark):
    ent = matrix.train_test_split(matrix.matrix_input(R.user_matrix(spark, SF01)))
    hashed = factor.fit_nmf(spark, ent, k=4, max_iter=40)
    svd = factor.fit_nmf(spark, ent, k=4, max_iter=40, start="svd")
    print("iterations: hash", hashed.iterations, "svd", svd.iterations)
    assert svd.objective <= hashed.objective * 1.02 and svd.iterations <= hashed.iterations
    assert all(x >= 0 for r in svd.user_factors.collect() for x in r.factors)
