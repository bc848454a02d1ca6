"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame, over the adapter tables.

Each query builds one ``Ctx``. Its inputs (clean log, catalogue, history, lists, ...) are built
once per query and shared by every operator that needs them. The plan then holds one subtree per
input, which Spark can reuse, not one copy per consumer.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.functions import columns as fx
from shelfrank.functions import constants as C
from shelfrank.operators import (baseline, catalog, clean, evaluate, factor, feed, matrix, profile, recommend,
                                 search, state)
from shelfrank.plans.store import Store
from shelfrank.sources import export, lookup, rejects
from shelfrank.sources import testdata as td
from shelfrank.streaming import refresh, runner
from shelfrank.streaming import keyed_state as ks
from shelfrank.streaming import user_state as us

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


class Ctx:
    """The engine tables of one sf folder, each built once (lazily) and shared. With ``stored``, what many
    parts of a query read (the clean log, the per-product aggregate) is written once to the shared folder,
    so the log is cleaned and shuffled once however often it is used."""

    def __init__(self, spark: SparkSession, d: str, stored: bool = False):
        self.spark, self.d = spark, d
        self.store = Store(spark, "query") if stored else None

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        return self.store.table(df, name) if self.store else df

    @cached_property
    def raw_log(self) -> DataFrame:
        return td.interactions(self.spark, self.d)

    @cached_property
    def log(self) -> DataFrame:
        return self._kept(clean.clean_interactions(self.raw_log), "log")

    @cached_property
    def popularity(self) -> DataFrame:
        return self._kept(catalog.product_popularity(self.log), "popularity")

    @cached_property
    def products(self) -> DataFrame:
        return clean.clean_products(td.products(self.spark, self.d))

    @cached_property
    def users(self) -> DataFrame:
        return clean.clean_users(td.users(self.spark, self.d))

    @cached_property
    def cmap(self) -> DataFrame:
        return td.complementary_map(self.spark, self.d)

    @cached_property
    def toggles(self) -> DataFrame:
        return td.toggles(self.spark, self.d)

    @cached_property
    def resets(self) -> DataFrame:
        return td.resets(self.spark, self.d)

    @cached_property
    def matrix(self) -> DataFrame:
        return matrix.user_product_matrix(self.log)

    @cached_property
    def split(self) -> DataFrame:
        return self._kept(matrix.train_test_split(matrix.matrix_input(self.matrix)), "split")

    @cached_property
    def prod_stats(self) -> DataFrame:
        if self.store:
            return catalog.engagement_of(self.products, self.popularity)
        return catalog.product_engagement(self.products, self.log)

    @cached_property
    def similar(self) -> DataFrame:
        return catalog.similar_products(self.prod_stats)

    @cached_property
    def complementary(self) -> DataFrame:
        return catalog.complementary_products(self.prod_stats, self.cmap)

    @cached_property
    def popular(self) -> DataFrame:
        return catalog.rank_popular(self.popularity, self.products)

    @cached_property
    def history(self) -> DataFrame:
        return feed.recent_interactions(self.log, self.resets)

    @cached_property
    def weights(self) -> DataFrame:
        return feed.time_decay_weights(self.history, feed.latest_ts(self.log))

    @cached_property
    def slots(self) -> DataFrame:
        return feed.feed_slots(self.weights)

    @cached_property
    def prefs(self) -> DataFrame:
        return feed.latest_preferences(td.preference_updates(self.spark, self.d), self.products, self.resets)

    @cached_property
    def user_cats(self) -> DataFrame:
        return feed.user_categories(self.users, self.prefs, self.products)

    @cached_property
    def wishlist(self) -> DataFrame:
        return state.wishlist_state(self.toggles, self.resets)

    @cached_property
    def cart(self) -> DataFrame:
        return state.cart_state(self.toggles, self.resets)

    @cached_property
    def detail(self) -> DataFrame:
        return feed.product_detail(self.products, self.similar, self.complementary)

    def feed_inputs(self) -> dict:
        return dict(slots=self.slots, similar=self.similar, complementary=self.complementary,
                    products=self.products, user_cats=self.user_cats, popular=self.popular)

    @cached_property
    def nmf(self):
        return factor.fit_nmf(self.spark, self.split)

    @cached_property
    def fixed_factors(self) -> tuple[DataFrame, DataFrame]:
        """Factors of md5 text for every user and product of the matrix: SQL can make the same ones."""
        return (factor.hashed_start(self.split.select("user_id").distinct(), "user_id", C.NUM_FACTORS, 1.0, C.RANDOM_SEED),
                factor.hashed_start(self.split.select("product_id").distinct(), "product_id", C.NUM_FACTORS, 1.0, C.RANDOM_SEED))

    @cached_property
    def fixed_recommendations(self) -> DataFrame:
        uf, itf = self.fixed_factors
        return recommend.recommend_top_n(uf, itf, self.split, self.products, C.NUM_FACTORS, item_block=32)

    @cached_property
    def recommendations(self) -> DataFrame:
        m = self.nmf
        return recommend.recommend_top_n(m.user_factors, m.item_factors, self.split, self.products, m.k)


# Helpers kept for tests and scripts: each builds its own context.
def clean_log(spark, d):
    return Ctx(spark, d).log


def clean_catalog(spark, d):
    return Ctx(spark, d).products


def prod_stats(spark, d):
    return Ctx(spark, d).prod_stats


def user_matrix(spark, d):
    return Ctx(spark, d).matrix


def history(spark, d):
    return Ctx(spark, d).history


def feed_inputs(spark, d):
    return Ctx(spark, d).feed_inputs()


def similar_of(spark, d):
    return Ctx(spark, d).similar


def joined(df: DataFrame, *cols: str) -> DataFrame:
    """Array columns as comma-joined text (for comparisons)."""
    return df.withColumns({c: F.array_join(c, ",") for c in cols})


# ---------------------------------------------------------------- cleaning and profiles

@register("clean_interactions")
def q_clean_interactions(spark, d):
    return Ctx(spark, d).log


@register("clean_products")
def q_clean_products(spark, d):
    return Ctx(spark, d).products


@register("rejected_rows")
def q_rejected_rows(spark, d):
    """S3: rows by reason of a log whose fields are text, with broken and missing values; ids of every 5th event are broken too."""
    log = td.text_interactions(spark, d).withColumnRenamed("ts", "timestamp")
    log = log.withColumn("product_id", F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("p"), "product_id")).otherwise(F.col("product_id").cast("string")))
    return rejects.counts(rejects.checked(log, "interactions"))


@register("clean_text_interactions")
def q_clean_text_interactions(spark, d):
    """P1-P5 on a log whose rating, sentiment and time are text, with empty, broken and missing values."""
    return clean.clean_interactions(td.text_interactions(spark, d), "yyyy-MM-dd HH:mm:ss").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("clean_odd_products")
def q_clean_odd_products(spark, d):
    """P4, P6, P7 on values that each rule changes."""
    return clean.clean_products(td.odd_products(spark, d))


@register("clean_odd_users")
def q_clean_odd_users(spark, d):
    return clean.clean_users(td.odd_users(spark, d))


@register("clean_users")
def q_clean_users(spark, d):
    return Ctx(spark, d).users


@register("interaction_distribution")
def q_interaction_distribution(spark, d):
    return profile.value_counts(Ctx(spark, d).log, "interaction_type")


@register("category_counts")
def q_category_counts(spark, d):
    return profile.value_counts(Ctx(spark, d).products, "category")


@register("membership_distribution")
def q_membership_distribution(spark, d):
    return profile.value_counts(Ctx(spark, d).users, "membership_type")


@register("category_profile")
def q_category_profile(spark, d):
    return profile.category_profile(Ctx(spark, d).products)


@register("run_summary")
def q_run_summary(spark, d):
    c = Ctx(spark, d)
    return profile.run_summary(c.users, c.products, c.raw_log, c.log, c.matrix)


@register("interaction_weights")
def q_interaction_weights(spark, d):
    return (Ctx(spark, d).raw_log.groupBy("interaction_type").agg(F.count("*").alias("n_events"))
            .withColumn("weight", fx.interaction_weight("interaction_type")))


@register("price_buckets")
def q_price_buckets(spark, d):
    return Ctx(spark, d).products.select("product_id", "price", fx.price_bucket("price").alias("price_bucket"))


@register("rating_sentiment")
def q_rating_sentiment(spark, d):
    return (Ctx(spark, d).raw_log.select("rating", fx.sentiment_from_rating("rating").alias("review_sentiment"))
            .groupBy("rating", "review_sentiment").agg(F.count("*").alias("n_events")))


@register("session_keys")
def q_session_keys(spark, d):
    return Ctx(spark, d).log.select("event_id", "user_id", "ts",
                                    fx.session_key("user_id", "ts").alias("hour_session_id"))


@register("product_names")
def q_product_names(spark, d):
    p = Ctx(spark, d).products
    return p.select("product_id", fx.display_name("brand", F.split_part("product_name", F.lit(" "), F.lit(1)),
                                                 "sub_category").alias("display_name"))


# ---------------------------------------------------------------- matrix

@register("user_product_matrix")
def q_user_product_matrix(spark, d):
    return joined(Ctx(spark, d).matrix, "interaction_types")


@register("matrix_input")
def q_matrix_input(spark, d):
    return matrix.matrix_input(Ctx(spark, d).matrix)


@register("score_stats")
def q_score_stats(spark, d):
    return profile.score_stats(Ctx(spark, d).matrix)


@register("matrix_shape")
def q_matrix_shape(spark, d):
    return matrix.matrix_shape(Ctx(spark, d).matrix)


@register("interaction_pivot")
def q_interaction_pivot(spark, d):
    return matrix.interaction_pivot(Ctx(spark, d).log)


@register("train_test_split")
def q_train_test_split(spark, d):
    return Ctx(spark, d).split


@register("split_counts")
def q_split_counts(spark, d):
    return matrix.split_counts(Ctx(spark, d).split)


# ---------------------------------------------------------------- catalogue lists

@register("popular_by_category")
def q_popular_by_category(spark, d):
    return Ctx(spark, d).popular


@register("product_popularity")
def q_product_popularity(spark, d):
    return catalog.product_popularity(Ctx(spark, d).log)


@register("product_engagement")
def q_product_engagement(spark, d):
    return Ctx(spark, d).prod_stats


@register("complementary_map")
def q_complementary_map(spark, d):
    return Ctx(spark, d).cmap


@register("similar_products")
def q_similar_products(spark, d):
    return Ctx(spark, d).similar


@register("complementary_products")
def q_complementary_products(spark, d):
    return Ctx(spark, d).complementary


@register("similar_for_ids")
def q_similar_for_ids(spark, d):
    """The lists of the products that some user has on the wishlist."""
    c = Ctx(spark, d)
    return catalog.similar_for_ids(c.similar, c.wishlist.select("product_id"))


@register("top_rated")
def q_top_rated(spark, d):
    return catalog.top_rated(Ctx(spark, d).products)


SEARCH_QUERY = "  Bolt "
SEARCH_CATEGORIES = ("ECONOMY", "SMALL")


@register("product_search")
def q_product_search(spark, d):
    return catalog.product_search(Ctx(spark, d).products, SEARCH_QUERY, SEARCH_CATEGORIES).select(
        "product_id", "product_name", "category", "sub_category", "brand")


@register("product_search_table")
def q_product_search_table(spark, d):
    """P14 for a table of queries, each within its own categories."""
    return search.product_search_table(Ctx(spark, d).products, td.search_queries(spark, d)).select("query_id", "product_id")


@register("category_listing")
def q_category_listing(spark, d):
    return catalog.category_listing(Ctx(spark, d).products)


# ---------------------------------------------------------------- feed

@register("recent_interactions")
def q_recent_interactions(spark, d):
    return Ctx(spark, d).history


@register("recency_frequency")
def q_recency_frequency(spark, d):
    return feed.recency_frequency(Ctx(spark, d).history)


@register("time_decay_weights")
def q_time_decay_weights(spark, d):
    return feed.rounded(Ctx(spark, d).weights, ["hours_ago", "weight"])


@register("feed_slots")
def q_feed_slots(spark, d):
    s = Ctx(spark, d).slots
    return feed.rounded(s.select("user_id", "product_id", "weight_rank", "weight", "slots", "sim_slots", "comp_slots"),
                        ["weight"])


@register("top_influencers")
def q_top_influencers(spark, d):
    c = Ctx(spark, d)
    return feed.top_influencers(c.slots, c.products)


@register("feed_explanation")
def q_feed_explanation(spark, d):
    c = Ctx(spark, d)
    return feed.feed_explanation(feed.top_influencers(c.slots, c.products))


@register("profile_history")
def q_profile_history(spark, d):
    c = Ctx(spark, d)
    return feed.profile_history(c.history, c.products)


@register("user_top_products")
def q_user_top_products(spark, d):
    return feed.user_top_products(Ctx(spark, d).log)


@register("user_top_category")
def q_user_top_category(spark, d):
    c = Ctx(spark, d)
    return feed.user_top_category(feed.user_top_products(c.log), c.products)


@register("latest_preferences")
def q_latest_preferences(spark, d):
    return joined(Ctx(spark, d).prefs, "categories")


@register("latest_preference_lists")
def q_latest_preference_lists(spark, d):
    """ST4 on updates that hold category lists."""
    return joined(feed.latest_preference_lists(td.preference_lists(spark, d), Ctx(spark, d).resets), "categories")


@register("user_categories")
def q_user_categories(spark, d):
    return joined(Ctx(spark, d).user_cats, "categories")


@register("cold_start_feed")
def q_cold_start_feed(spark, d):
    c = Ctx(spark, d)
    return feed.cold_start_feed(c.user_cats, c.popular, c.history)


@register("category_sections")
def q_category_sections(spark, d):
    c = Ctx(spark, d)
    return feed.category_sections(c.user_cats, c.products)


@register("product_detail")
def q_product_detail(spark, d):
    return joined(Ctx(spark, d).detail, "similar_ids", "complementary_ids")


@register("user_product_detail")
def q_user_product_detail(spark, d):
    c = Ctx(spark, d)
    out = feed.user_product_detail(c.detail, c.history, c.wishlist, c.cart)
    return joined(out.select("user_id", "product_id", "product_name", "similar_ids", "complementary_ids",
                             "in_wishlist", "in_cart"), "similar_ids", "complementary_ids")


@register("feed_candidates")
def q_feed_candidates(spark, d):
    c = Ctx(spark, d)
    return feed.feed_candidates(c.slots, c.similar, c.complementary, c.user_cats, c.popular)


@register("personal_feed")
def q_personal_feed(spark, d):
    return feed.personal_feed(**Ctx(spark, d, stored=True).feed_inputs())


@register("unseen_pairs")
def q_unseen_pairs(spark, d):
    """J7 on the popular candidates only (at most 8 of each category); over all pairs the mask of seen ones is
    covered by fixed_factor_top_n and order_log_recommend."""
    c = Ctx(spark, d)
    m = c.matrix
    cats = c.user_cats.join(m.select("user_id").distinct(), "user_id", "left_semi")
    cand = cats.select("user_id", F.explode("categories").alias("category")).join(
        c.popular.select("category", "product_id"), "category")
    return cand.join(m.select("user_id", "product_id"), ["user_id", "product_id"], "left_anti")


@register("baseline_recommender")
def q_baseline_recommender(spark, d):
    c = Ctx(spark, d)
    return baseline.baseline_recommender(c.log, c.products)


# ---------------------------------------------------------------- user state

@register("wishlist_state")
def q_wishlist_state(spark, d):
    return Ctx(spark, d).wishlist


@register("cart_state")
def q_cart_state(spark, d):
    return Ctx(spark, d).cart


@register("toggle_history")
def q_toggle_history(spark, d):
    """ST2, ST3, W7: likes and additions to the cart join the history, removals do not."""
    c = Ctx(spark, d)
    log = c.log.filter(F.col("interaction_type").isin("view", "purchase"))
    return feed.recent_interactions(state.with_additions(log, c.toggles, c.resets), c.resets)


@register("toggle_feed_weights")
def q_toggle_feed_weights(spark, d):
    """F1 over the history with additions."""
    c = Ctx(spark, d)
    log = state.with_additions(c.log.filter(F.col("interaction_type").isin("view", "purchase")), c.toggles, c.resets)
    w = feed.time_decay_weights(feed.recent_interactions(log, c.resets), feed.latest_ts(log))
    return feed.rounded(w, ["hours_ago", "weight"])


@register("profile_counts")
def q_profile_counts(spark, d):
    c = Ctx(spark, d)
    return state.profile_counts(c.wishlist, c.cart, c.history)


@register("state_after_reset")
def q_state_after_reset(spark, d):
    c = Ctx(spark, d)
    return state.state_after_reset(c.resets, c.wishlist, c.cart, c.history)


@register("hourly_sessions")
def q_hourly_sessions(spark, d):
    return state.hourly_sessions(Ctx(spark, d).log)


# ---------------------------------------------------------------- model

def _factor_text(df, key):
    return df.select(F.col(key).alias("id"), F.array_join(F.transform("factors", lambda x: F.format_number(x, 6)), ",")
                     .alias("factors"))


@register("nmf_factors")
def q_nmf_factors(spark, d):
    m = Ctx(spark, d).nmf
    return (_factor_text(m.user_factors, "user_id").withColumn("side", F.lit("user"))
            .unionByName(_factor_text(m.item_factors, "product_id").withColumn("side", F.lit("product"))))


@register("recommend_top_n")
def q_recommend_top_n(spark, d):
    return Ctx(spark, d, stored=True).recommendations


@register("model_metrics")
def q_model_metrics(spark, d):
    c = Ctx(spark, d, stored=True)
    return evaluate.model_metrics(spark, c.split, c.nmf)


@register("als_recommendations")
def q_als_recommendations(spark, d):
    c = Ctx(spark, d, stored=True)
    _, uf, itf = factor.fit_als(c.split)
    return recommend.recommend_top_n(uf, itf, c.split, c.products, C.NUM_FACTORS)


@register("fixed_factor_top_n")
def q_fixed_factor_top_n(spark, d):
    """M5, J1, J12, W5 on fixed factors, over several item blocks."""
    return Ctx(spark, d, stored=True).fixed_recommendations


@register("fixed_factor_metrics")
def q_fixed_factor_metrics(spark, d):
    """M6, A12, A13 on fixed factors."""
    c = Ctx(spark, d)
    return feed.rounded(evaluate.error_metrics(evaluate.test_predictions(c.split, *c.fixed_factors)), ["rmse", "mae"])


@register("nmf_half_step")
def q_nmf_half_step(spark, d):
    """M2: what one half step of the fit solves with: per product the weighted factor sums of its training
    cells, and (as product null) the Gram matrix of the user factors, row by row."""
    c = Ctx(spark, d)
    k, (uf, _) = C.NUM_FACTORS, c.fixed_factors
    train = c.split.filter("is_train").select("user_id", "product_id", F.col("final_score").alias("score")).withColumn(
        "salt", F.pmod(F.xxhash64("product_id"), F.lit(factor.SALTS)).cast("int"))
    b = factor._weighted_sums(train, uf, "user_id", "product_id", k).select("product_id", F.posexplode("b").alias("f", "value"))
    g = factor.gram(uf, k)
    rows = [(None, i * k + j, float(g[i, j])) for i in range(k) for j in range(k)]
    return feed.rounded(b.unionByName(spark.createDataFrame(rows, "product_id long, f int, value double")), ["value"])


@register("reconstruction_error")
def q_reconstruction_error(spark, d):
    """A14 on fixed factors: ||R_train - W H|| over the whole matrix, unobserved cells 0."""
    c = Ctx(spark, d)
    return feed.rounded(evaluate.reconstruction_error(c.split, *c.fixed_factors, C.NUM_FACTORS), ["reconstruction_error"])


@register("export_fixed_recommendations")
def q_export_fixed_recommendations(spark, d):
    return export.item_ids(export.export_recommendations(Ctx(spark, d, stored=True).fixed_recommendations), "user_id")


@register("lookup_fixed_recommendations")
def q_lookup_fixed_recommendations(spark, d):
    c = Ctx(spark, d, stored=True)
    return export.item_ids(lookup.lookup(export.export_recommendations(c.fixed_recommendations), "user_id", c.users), "user_id")


@register("run_summary_model")
def q_run_summary_model(spark, d):
    """A10 with the model's rows, on fixed factors."""
    c = Ctx(spark, d, stored=True)
    metrics = evaluate.error_metrics(evaluate.test_predictions(c.split, *c.fixed_factors))
    return profile.model_summary(metrics, c.fixed_recommendations)


@register("error_metrics")
def q_error_metrics(spark, d):
    m = evaluate.error_metrics(evaluate.user_mean_predictions(Ctx(spark, d).split))
    return feed.rounded(m, ["rmse", "mae"])


# ---------------------------------------------------------------- exports and lookups

@register("export_recommendations")
def q_export_recommendations(spark, d):
    return export.item_ids(export.export_recommendations(Ctx(spark, d, stored=True).recommendations), "user_id")


@register("export_popular")
def q_export_popular(spark, d):
    return export.item_ids(export.export_popular(Ctx(spark, d).popular), "category")


@register("export_similar")
def q_export_similar(spark, d):
    return export.item_ids(export.export_similar(Ctx(spark, d).similar), "source_product_id")


@register("export_complementary")
def q_export_complementary(spark, d):
    return export.item_ids(export.export_complementary(Ctx(spark, d).complementary), "source_product_id")


@register("export_top_rated")
def q_export_top_rated(spark, d):
    return export.export_top_rated(catalog.top_rated(Ctx(spark, d).products))


@register("catalog_export")
def q_catalog_export(spark, d):
    return export.catalog_export(Ctx(spark, d).products)


def _asked_products(c: Ctx) -> DataFrame:
    """Every product of the catalogue, and as many unknown ids."""
    ids = c.products.select(F.col("product_id").alias("source_product_id"))
    return ids.union(ids.select(F.col("source_product_id") + 1_000_000_000))


@register("lookup_recommendations")
def q_lookup_recommendations(spark, d):
    c = Ctx(spark, d, stored=True)
    keyed = export.export_recommendations(c.recommendations)
    return export.item_ids(lookup.lookup(keyed, "user_id", c.users), "user_id")


@register("lookup_similar")
def q_lookup_similar(spark, d):
    c = Ctx(spark, d)
    keyed = export.export_similar(c.similar)
    return export.item_ids(lookup.lookup(keyed, "source_product_id", _asked_products(c)), "source_product_id")


@register("lookup_complementary")
def q_lookup_complementary(spark, d):
    c = Ctx(spark, d)
    keyed = export.export_complementary(c.complementary)
    return export.item_ids(lookup.lookup(keyed, "source_product_id", _asked_products(c)), "source_product_id")


# ---------------------------------------------------------------- streams

def stream_state(spark, d):
    """Run the user-state stream over the events file; return the latest snapshot per user."""
    root = runner.run_root(spark, "user-state")
    runner.run_available(us.user_state_stream(td.state_events(runner.events_stream(spark, d, "events.parquet"))), root)
    return us.latest_snapshots(spark.read.parquet(f"{root}/out")), root


@register("stream_recent_interactions")
def q_stream_recent_interactions(spark, d):
    return us.history_rows(stream_state(spark, d)[0])


@register("stream_wishlist_state")
def q_stream_wishlist_state(spark, d):
    return us.list_rows(stream_state(spark, d)[0], "wishlist")


@register("stream_cart_state")
def q_stream_cart_state(spark, d):
    return us.list_rows(stream_state(spark, d)[0], "cart")


@register("stream_latest_preferences")
def q_stream_latest_preferences(spark, d):
    snap = stream_state(spark, d)[0].filter(F.col("pref_event_id").isNotNull())
    p = feed.name_categories(snap.select("user_id", F.col("pref_event_id").alias("event_id"), "c1", "c2", "n_categories"),
                             Ctx(spark, d).products)
    return joined(p, "categories")


def keyed_state(spark, d):
    """Run the keyed user state over the events file; return the latest snapshot per user."""
    root = runner.run_root(spark, "keyed-state")
    runner.run_available(ks.user_state_stream(td.list_events(runner.events_stream(spark, d, "events.parquet"))), root, state_store=ks.PROVIDER)
    return us.latest_snapshots(spark.read.parquet(f"{root}/out"))


@register("stream_toggle_history")
def q_stream_toggle_history(spark, d):
    """ST1-ST3, W7 from keyed state: additions to the lists are events of the history."""
    return us.history_rows(keyed_state(spark, d))


@register("stream_preference_lists")
def q_stream_preference_lists(spark, d):
    """ST4 on category lists from keyed state."""
    return joined(ks.preference_rows(keyed_state(spark, d)), "categories")


@register("stream_popular_by_category")
def q_stream_popular_by_category(spark, d):
    root = runner.run_root(spark, "popular")
    hook = refresh.PopularRefresher(spark, Ctx(spark, d).products, root)
    scores, users = refresh.popularity_streams(td.state_events(runner.events_stream(spark, d, "events.parquet")))
    runner.run_available_with([("scores", scores, hook.hook("scores"), "update"),
                               ("users", users, hook.hook("users"), "update")], root)
    return refresh.current(spark, f"{root}/popular")


@register("stream_hourly_sessions")
def q_stream_hourly_sessions(spark, d):
    events = td.state_events(runner.events_stream(spark, d, "events.parquet"))
    return refresh.run_hourly(events, runner.run_root(spark, "hourly"))


@register("stream_personal_feed")
def q_stream_personal_feed(spark, d):
    c = Ctx(spark, d)
    root = runner.run_root(spark, "feed")
    hook = refresh.FeedRefresher(spark, c.products, c.similar, c.complementary, c.popular, c.users, f"{root}/feed")
    runner.run_available(us.user_state_stream(td.state_events(runner.events_stream(spark, d, "events.parquet"))), root, hook)
    return refresh.latest_feed(spark.read.parquet(f"{root}/feed"), spark.read.parquet(f"{root}/out"))


# ---------------------------------------------------------------- volume (order log)

def order_log(spark, d):
    return clean.clean_interactions(td.order_interactions(spark, d))


@register("order_log_popular")
def q_order_log_popular(spark, d):
    return catalog.popular_by_category(Ctx(spark, d).products, order_log(spark, d))


@register("order_log_matrix_stats")
def q_order_log_matrix_stats(spark, d):
    return profile.score_stats(matrix.user_product_matrix(order_log(spark, d)))


@register("order_log_recommend")
def q_order_log_recommend(spark, d):
    """M5 on the whole order log (every customer and part) from fixed factors, over many item blocks."""
    c = Ctx(spark, d)
    pairs = order_log(spark, d).select("user_id", "product_id").distinct()
    log = Store(spark, "order-log").table(pairs, "pairs")  # read by many jobs: cleaned and shuffled once
    uf = factor.hashed_start(log.select("user_id").distinct(), "user_id", C.NUM_FACTORS, 1.0, C.RANDOM_SEED)
    itf = factor.hashed_start(c.products.select("product_id"), "product_id", C.NUM_FACTORS, 1.0, C.RANDOM_SEED)
    return recommend.recommend_top_n(uf, itf, log, c.products, C.NUM_FACTORS, user_block=4096, item_block=512).select(
        "user_id", "rec_rank", "product_id", "product_name", "predicted_score")
