"""Catalogue lists on hand-made rows (O1, O2, T3, T4). The twins check them on whole tables: their SQL is the uncut definition."""

from pyspark.sql import functions as F

from conftest import SF01
from shelfrank.operators import catalog
from shelfrank.plans import registry as R
from shelfrank.sources import export, testdata as td

STATS = "product_id long, product_name string, category string, sub_category string, brand string, " \
        "price double, avg_rating double, total_engagement long"


def test_small_groups_ties_unmapped_and_self_map(spark):
    rows = [
        (1, "p1", "C", "solo", "b", 1.0, 4.0, 0),       # group of one: no similar products
        (2, "p2", "C", "pair", "b", 1.0, 4.0, 5),
        (3, "p3", "C", "pair", "b", 1.0, 4.0, 5),       # tie with 2 -> product_id decides
        (4, "p4", "D", "tri", "b", 1.0, 3.0, 1),
        (5, "p5", "D", "tri", "b", 1.0, 3.0, 1),
        (6, "p6", "D", "tri", "b", 1.0, 3.0, 1),
        (7, "p7", "D", "nomap", "b", 1.0, 5.0, 9),
    ]
    ps = spark.createDataFrame(rows, STATS)
    sim = {(r.source_product_id, r.sim_rank): r.similar_product_id for r in catalog.similar_products(ps).collect()}
    assert 1 not in {s for s, _ in sim}
    assert sim[(2, 1)] == 3 and sim[(3, 1)] == 2
    assert [sim[(4, 1)], sim[(4, 2)]] == [5, 6]
    cmap = spark.createDataFrame([("pair", "tri"), ("tri", "tri"), ("tri", "pair")], "source_sub_category string, target_sub_category string")
    comp = catalog.complementary_products(ps, cmap).collect()
    got = {}
    for r in comp:
        got.setdefault(r.source_product_id, []).append((r.comp_rank, r.comp_product_id))
    assert sorted(got[2]) == [(1, 4), (2, 5), (3, 6)]
    assert sorted(got[4]) == [(1, 2), (2, 3), (3, 5), (4, 6)]   # pair first (rating 4), self excluded
    assert 7 not in got and 1 not in got                     # unmapped sources have no list


def test_orphans_are_ranked_but_not_exported(spark):
    products = spark.createDataFrame([(1, "a", "X", "b", 1.0, 4.0)],
                                     "product_id long, product_name string, category string, brand string, price double, avg_rating double")
    inter = spark.createDataFrame([(1, 1, 5), (2, 99, 1)], "user_id long, product_id long, interaction_score int")
    pop = catalog.popular_by_category(products, inter).collect()
    assert {(r.category, r.product_id) for r in pop} == {("X", 1), (None, 99)}
    exp = export.export_popular(catalog.popular_by_category(products, inter)).collect()
    assert [r.category for r in exp] == ["X"]


def test_top_rated_threshold_and_order(spark):
    rows = [(1, 4.5, 60), (2, 4.5, 70), (3, 5.0, 10), (4, 4.0, 500), (5, 4.5, 70)]
    df = spark.createDataFrame(rows, "product_id long, avg_rating double, rating_count long").select(
        "product_id", F.lit("n").alias("product_name"), F.lit("c").alias("category"), F.lit("b").alias("brand"),
        F.lit(1.0).alias("price"), "avg_rating", "rating_count")
    got = [r.product_id for r in catalog.top_rated(df, n=3).orderBy("rank").collect()]
    assert got == [2, 5, 1]


def test_search(spark):
    rows = [(1, "Red Bolt", "A", "A bolt", "Acme"), (2, "blue ring", "B", None, "BOLTCO"), (3, "x", "A", "A ring", "y")]
    p = spark.createDataFrame(rows, "product_id long, product_name string, category string, sub_category string, brand string")
    assert {r.product_id for r in catalog.product_search(p, "  BOLT ").collect()} == {1, 2}
    assert {r.product_id for r in catalog.product_search(p, "bolt", ["A"]).collect()} == {1}
    assert catalog.product_search(p, "   ").count() == 0
    assert catalog.product_search(p, "zzz").count() == 0


def test_literal_map_and_in_list(spark):
    m = td.complementary_map_from_dict(spark)
    assert m.count() == 76 and m.select("source_sub_category").distinct().count() == 30
    sim = catalog.similar_products(R.prod_stats(spark, SF01))
    got = catalog.similar_for_ids(sim, [1, 2, 3])
    assert {r.source_product_id for r in got.collect()} == {1, 2, 3}


def test_one_sub_category_with_half_of_the_catalogue_is_spread(spark):
    """Without broadcast, the sources of a hot sub-category are joined in many tasks, with the same lists."""
    n = 4000
    rows = spark.range(n).select(
        F.col("id").alias("product_id"), F.concat(F.lit("p"), "id").alias("product_name"), F.lit("c").alias("category"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 100)).alias("sub_category"),
        F.lit("b").alias("brand"), F.lit(1.0).alias("price"), (F.col("id") % 7).cast("double").alias("avg_rating"),
        (F.col("id") % 11).alias("total_engagement"))
    want = {tuple(r) for r in catalog.similar_products(rows).select("source_product_id", "similar_product_id", "sim_rank").collect()}
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = catalog.similar_products(rows)
        assert {tuple(r) for r in out.select("source_product_id", "similar_product_id", "sim_rank").collect()} == want
        parts = catalog._salted(rows.withColumnRenamed("product_id", "source_product_id").filter("sub_category = 'hot'"))
        sizes = [r["count"] for r in parts.groupBy(F.pmod(F.hash("sub_category", "_salt"), F.lit(8)).alias("t")).count().collect()]
        assert len(sizes) >= 5 and max(sizes) < n / 4  # of the 2,000 hot sources
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    top = catalog.similar_products(rows).filter("source_product_id = 6 and sim_rank = 1").first()
    assert top.similar_product_id == 76  # even, 76 % 7 = 6 and 76 % 11 = 10: the best rated, most engaging
