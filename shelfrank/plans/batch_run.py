"""The whole batch run: inputs -> the six result sets -> keyed JSON exports (the reference's flow).

    inputs = from_csv(spark, "users.csv", "products.csv", "interactions.csv")
    sets = build_results(spark, inputs)
    write_results(spark, sets, "<shared folder>/results")       # executors write; nothing is collected
    run_summary(inputs, sets).show()

What several results read (the clean log, the split matrix, the per-product aggregate) is computed once
and stored in the checkpoint folder, as are the fitted factors, the metrics and the recommendations; the other results
are lazy. The row counts of the stored tables come from their writes (``Results.figures``), not from another scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.functions import constants as C
from shelfrank.operators import catalog, clean, evaluate, factor, feed, matrix, profile, recommend
from shelfrank.plans.store import Store
from shelfrank.sources import export, files, results
from shelfrank.sources import testdata as td


@dataclass
class Inputs:
    users: DataFrame
    products: DataFrame
    interactions: DataFrame        # raw log, cleaned by build_results
    complementary_map: DataFrame


def from_csv(spark: SparkSession, users: str, products: str, interactions: str,
             complementary_map: DataFrame | None = None) -> Inputs:
    """The three CSV tables with fixed schemas, and the complementary map (by default the
    reference catalogue's literal map)."""
    cmap = complementary_map if complementary_map is not None else td.complementary_map_from_dict(spark)
    return Inputs(files.read_users(spark, users), files.read_products(spark, products),
                  files.read_interactions(spark, interactions), cmap)


def from_testdata(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(td.users(spark, sf_dir), td.products(spark, sf_dir), td.interactions(spark, sf_dir),
                  td.complementary_map(spark, sf_dir))


@dataclass
class Results:
    users: DataFrame
    products: DataFrame
    interactions: DataFrame
    matrix: DataFrame
    split: DataFrame
    model: factor.NMFModel
    recommendations: DataFrame
    popular: DataFrame
    similar: DataFrame
    complementary: DataFrame
    top_rated: DataFrame
    metrics: DataFrame
    feed: DataFrame
    figures: dict[str, int]        # counts that the writes of the stored tables made


def build_results(spark: SparkSession, inputs: Inputs, k: int = C.NUM_FACTORS, max_iter: int = C.MAX_ITERATIONS,
                  n: int = C.RECOMMENDATIONS_PER_USER, **nmf_args) -> Results:
    store = Store(spark, "batch-run")
    rows, train = F.count(F.lit(1)), F.col("is_train")
    users = store.table(clean.clean_users(inputs.users), "users", users=rows)
    products = store.table(clean.clean_products(inputs.products), "products", products=rows)
    log = store.table(clean.with_event_ids(clean.clean_interactions(inputs.interactions)), "log", interactions=rows)
    m = store.table(matrix.user_product_matrix(log), "matrix", matrix_pairs=rows)
    split = store.table(matrix.train_test_split(matrix.matrix_input(m)), "split",
                        train_entries=F.count_if(train), test_entries=F.count_if(~train))
    popularity = store.table(catalog.product_popularity(log), "popularity")
    stats = catalog.engagement_of(products, popularity)
    popular = store.table(catalog.rank_popular(popularity, products), "popular")
    similar = store.table(catalog.similar_products(stats), "similar")
    complementary = store.table(catalog.complementary_products(stats, inputs.complementary_map), "complementary")
    model = factor.fit_nmf(spark, split, k=k, max_iter=max_iter, **nmf_args)
    top = recommend.recommend_top_n(model.user_factors, model.item_factors, split, products, k, n)
    recommendations = store.table(top, "recommendations", users_served=F.count_if(F.col("rec_rank") == 1))
    metrics = store.table(evaluate.model_metrics(spark, split, model), "metrics")
    none = spark.createDataFrame([], "user_id long, categories array<string>")
    slots = feed.feed_slots(feed.time_decay_weights(feed.recent_interactions(log), feed.latest_ts(log)))
    return Results(
        users=users, products=products, interactions=log, matrix=m, split=split, model=model,
        recommendations=recommendations,
        popular=popular, similar=similar, complementary=complementary,
        top_rated=catalog.top_rated(products),
        metrics=metrics,
        feed=feed.personal_feed(slots, similar, complementary, products, feed.user_categories(users, none, products), popular),
        figures={name: value for seen in store.seen.values() for name, value in seen.items()},
    )


def write_results(spark: SparkSession, r: Results, out_dir: str) -> int:
    """S7-S12 + S14: the six result sets as a new version below ``out_dir``; returns its number. Readers see it when all six
    are written."""
    return results.write_version(spark, out_dir, {
        "recommendations": export.export_recommendations(r.recommendations),
        "popular_by_category": export.export_popular(r.popular),
        "similar_products": export.export_similar(r.similar),
        "complementary_products": export.export_complementary(r.complementary),
        "top_rated": export.export_top_rated(r.top_rated),
        "products": export.catalog_export(r.products),
    })


def run_summary(inputs: Inputs, r: Results) -> DataFrame:
    """A10: row counts of the run and the model's rows, all as doubles. The raw log and the matrix's user ids are read; all other
    counts are those of the writes."""
    counts = profile.stored_summary(r.figures, inputs.interactions, r.matrix)
    served = r.users.sparkSession.createDataFrame([("users_served", float(r.figures["users_served"]))], "metric string, value double")
    return (counts.withColumn("value", F.col("value").cast("double"))
            .unionByName(profile.error_summary(r.metrics)).unionByName(served))


def split_counts(r: Results) -> DataFrame:
    """A15 of the run, as the write of the split counted it."""
    names = ("train_entries", "test_entries")
    return r.users.sparkSession.createDataFrame([tuple(int(r.figures[n]) for n in names)], ", ".join(f"{n} long" for n in names))
