"""Adapters: the driver's parquet tables -> the engine's tables (users, products, interactions, ...).

Every adapter is a lazy DataFrame over the parquet scan, so filters and column pruning reach the
reader. The derived columns are artificial (the driver tables have no ratings or sub-categories);
the same rules are written in SQL in ``plans/oracle_sql.py``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfrank.functions.columns import event_time, ntz_micros, price_bucket, sentiment_from_rating

# Price bounds of the adapter catalogue (its prices lie near 900..2100).
ADAPTER_PRICE_BOUNDS = (925.0, 950.0, 975.0)
# Offsets (category step, noun step) that turn a sub-category into its three complementary targets.
ADAPTER_COMPLEMENT_OFFSETS = ((0, 1), (0, 2), (1, 0))
INTERACTION_EVENT_TYPES = ("view", "click", "signup", "purchase")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _prop_k() -> F.Column:
    return F.expr("try_cast(get_json_object(props, '$.k') AS BIGINT)")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.concat_ws(" ", "p_type", F.split_part("p_name", F.lit(" "), F.lit(2))).alias("sub_category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
        price_bucket("p_retailprice", ADAPTER_PRICE_BOUNDS).alias("price_range"),
        ((F.lit(25) + (F.col("p_partkey") * 7 + F.col("p_size")) % 26).cast("double") / 10).alias("avg_rating"),
        ((F.col("p_partkey") * 37 + F.col("p_size") * 11) % 500).alias("rating_count"),
        ((F.col("p_partkey") * 13) % 501).alias("stock"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    age = ["18-24", "25-34", "35-44", "45-54", "55+"]
    seg = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    age_col = F.element_at(F.array(*[F.lit(a) for a in age]), (F.col("c_custkey") % 5 + 1).cast("int"))
    seg_col = F.element_at(F.array(*[F.lit(s) for s in seg]), (F.col("c_custkey") % 6 + 1).cast("int"))
    member = (F.when(F.col("c_acctbal") < 0, "Free").when(F.col("c_acctbal") < 3000, "Silver")
              .when(F.col("c_acctbal") < 7000, "Gold").otherwise("Platinum"))
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_custkey").alias("user_id"), age_col.alias("age_group"),
                    F.col("n_name").alias("location"), seg_col.alias("preferred_category"),
                    member.alias("membership_type")))


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw interaction log (before cleaning): one row per view/click/add_to_cart/purchase event."""
    e = _read(spark, sf_dir, "events").filter(F.col("event_type").isin(*INTERACTION_EVENT_TYPES))
    et = F.col("event_type")
    rating = F.when((et == "purchase") | ((et == "signup") & (F.col("event_id") % 10 < 3)),
                    (F.lit(1) + F.col("event_id") % 5).cast("double"))
    return e.select(
        "event_id", "user_id",
        _prop_k().alias("product_id"),
        F.when(et == "signup", "add_to_cart").otherwise(et).alias("interaction_type"),
        F.when(et == "view", 1).when(et == "click", 2).when(et == "signup", 3).otherwise(5).alias("interaction_score"),
        rating.alias("rating"),
        sentiment_from_rating(rating).alias("review_sentiment"),
        "ts",
        F.substring(F.md5(F.concat_ws("-", F.col("user_id").cast("string"),
                                      F.col("ts").cast("date").cast("string"))), 1, 12).alias("session_id"),
    )


def text_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interaction log as a CSV would hold it, rating, sentiment and time as text: every 7th rating is
    no number, missing ones are '' or blank, every 11th time is broken, every 13th user is missing."""
    log, n = interactions(spark, sf_dir), F.col("event_id")
    blank = F.when(n % 2 == 0, "").otherwise("  ")
    return log.withColumns({
        "rating": F.when(n % 7 == 0, "n/a").otherwise(F.coalesce(F.col("rating").cast("string"), blank)),
        "review_sentiment": F.coalesce("review_sentiment", F.lit("")),
        "ts": F.when(n % 11 == 0, "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")),
        "user_id": F.when(n % 13 != 0, F.col("user_id")),
    })


def odd_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue with values out of range: negative prices, ratings below 0 and above 5, missing prices,
    ratings, names and ids."""
    n = F.col("product_id")
    return products(spark, sf_dir).withColumns({
        "price": F.when(n % 5 == 0, -F.col("price")).when(n % 7 != 0, F.col("price")),
        "avg_rating": F.when(n % 3 == 0, F.col("avg_rating") * 2).when(n % 4 == 0, -F.col("avg_rating")).when(n % 11 != 0, F.col("avg_rating")),
        "product_name": F.when(n % 13 != 0, F.col("product_name")),
        "product_id": F.when(n % 17 != 0, n),
    })


def odd_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user table with every 4th id missing."""
    return users(spark, sf_dir).withColumn("user_id", F.when(F.col("user_id") % 4 != 0, F.col("user_id")))


def order_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The larger order log as purchases (volume input): lineitem JOIN orders."""
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("event_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"),
        F.lit("purchase").alias("interaction_type"),
        F.lit(5).alias("interaction_score"),
        (F.lit(1) + (F.col("l_orderkey") + F.col("l_linenumber")) % 5).cast("double").alias("rating"),
        sentiment_from_rating((F.lit(1) + (F.col("l_orderkey") + F.col("l_linenumber")) % 5)).alias("review_sentiment"),
        F.col("o_orderdate").alias("ts"),
        F.col("l_orderkey").cast("string").alias("session_id"),
    )


def complementary_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_sub_category, target_sub_category): each sub-category points to three others.

    Categories and nouns are numbered in sorted order; a source (c, n) maps to (c, n+1), (c, n+2) and
    (c+1, n), wrapping around. Only sub-categories present in the catalogue are sources.
    """
    p = _read(spark, sf_dir, "part").select(
        F.col("p_type").alias("category"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("noun"))
    # Distinct categories / nouns form small dimension tables; the global window runs on them only.
    cat = (p.select("category").distinct()
           .withColumn("ci", F.row_number().over(Window.orderBy("category")) - 1)
           .withColumn("nc", F.count("*").over(Window.partitionBy())))
    noun = (p.select("noun").distinct()
            .withColumn("ni", F.row_number().over(Window.orderBy("noun")) - 1)
            .withColumn("nn", F.count("*").over(Window.partitionBy())))
    offsets = F.array(*[F.struct(F.lit(dc).alias("dc"), F.lit(dn).alias("dn")) for dc, dn in ADAPTER_COMPLEMENT_OFFSETS])
    src = (p.distinct().join(cat, "category").join(noun, "noun")
           .select("category", "noun", "ci", "nc", "ni", "nn", F.explode(offsets).alias("o")))
    tgt = src.select(
        F.concat_ws(" ", "category", "noun").alias("source_sub_category"),
        ((F.col("ci") + F.col("o.dc")) % F.col("nc")).alias("tci"),
        ((F.col("ni") + F.col("o.dn")) % F.col("nn")).alias("tni"))
    cat2 = cat.select(F.col("ci").alias("tci"), F.col("category").alias("tcat"))
    noun2 = noun.select(F.col("ni").alias("tni"), F.col("noun").alias("tnoun"))
    return (tgt.join(cat2, "tci").join(noun2, "tni")
            .select("source_sub_category", F.concat_ws(" ", "tcat", "tnoun").alias("target_sub_category")))


def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, query, categories): for each supplier a part of the name of the product with its number, upper-cased and padded;
    every other one within that product's category."""
    i = F.col("s_suppkey")
    p = products(spark, sf_dir).select("product_id", "product_name", "category")
    s = _read(spark, sf_dir, "supplier").select("s_suppkey").join(p, i == F.col("product_id"))
    part = F.substring(F.col("product_name"), (F.lit(1) + i % 9).cast("int"), (F.lit(1) + i % 11).cast("int"))
    return s.select(i.alias("query_id"), F.concat(F.lit(" "), F.upper(part), F.lit(" ")).alias("query"),
                    F.when(i % 2 == 0, F.array("category")).alias("categories"))


def toggles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wishlist / cart toggle events: clicks toggle the like, signups toggle the cart."""
    e = _read(spark, sf_dir, "events").filter(F.col("event_type").isin("click", "signup"))
    return e.select("event_id", "user_id", _prop_k().alias("product_id"),
                    F.when(F.col("event_type") == "click", "like_toggle").otherwise("cart_toggle").alias("action"),
                    "ts")


def resets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, the event id of the last state reset."""
    e = _read(spark, sf_dir, "events").filter((F.col("event_type") == "error") & (F.col("event_id") % 50 == 0))
    return e.groupBy("user_id").agg(F.max("event_id").alias("reset_event_id"))


def preference_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category preference updates: c1, c2 index the sorted categories; n_categories in 1..3."""
    e = _read(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    return e.select("event_id", "user_id", "ts",
                    (F.col("event_id") % 6).alias("c1"),
                    ((F.col("event_id") + 1 + F.col("event_id") % 2) % 6).alias("c2"),
                    (F.lit(1) + F.col("event_id") % 3).alias("n_categories"))


def preference_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preference updates with their categories by name, in the order chosen."""
    u = preference_updates(spark, sf_dir)
    return u.select("event_id", "user_id", "ts", _named(F.col("c1"), F.col("c2"), F.col("n_categories")).alias("categories"))


def _named(c1: F.Column, c2: F.Column, n: F.Column) -> F.Column:
    cats = F.array(*[F.lit(c) for c in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")])
    picks = F.slice(F.array(c1, c2, (c2 + 1) % 6), 1, n.cast("int"))
    return F.transform(picks, lambda i: F.element_at(cats, (i + 1).cast("int")))


def list_events(events: DataFrame) -> DataFrame:
    """``state_events`` as ``streaming.keyed_state`` takes them: preference updates hold their categories, and what a toggle stands for
    (clicks, additions to the cart) is no interaction of its own."""
    rows = state_events(events)
    own = (F.col("kind") != "interaction") | F.col("interaction_type").isin("view", "purchase")
    categories = F.when(F.col("kind") == "preferences", _named(F.col("c1"), F.col("c2"), F.col("n_categories")))
    return rows.filter(own).withColumn("categories", categories).drop("c1", "c2", "n_categories")


def state_events(events: DataFrame) -> DataFrame:
    """Raw events -> (event_id, user_id, ts timestamp, kind, product_id, interaction_type, session_id,
    c1, c2, n_categories). A click is an interaction and a like toggle; a signup an add_to_cart and a
    cart toggle; an error a preference update, and every 50th event id also a reset."""
    et = F.col("event_type")
    kinds = F.filter(F.array(
        F.when(et.isin("view", "click", "signup", "purchase"), F.lit("interaction")),
        F.when(et == "click", F.lit("like_toggle")),
        F.when(et == "signup", F.lit("cart_toggle")),
        F.when(et == "error", F.lit("preferences")),
        F.when((et == "error") & (F.col("event_id") % 50 == 0), F.lit("reset")),
    ), lambda k: k.isNotNull())
    return events.select(
        "event_id", "user_id", event_time("ts").alias("ts"), ntz_micros("ts").alias("ts_us"),
        F.explode(kinds).alias("kind"),
        F.expr("try_cast(get_json_object(props, '$.k') AS BIGINT)").alias("product_id"),
        F.when(et == "signup", "add_to_cart").otherwise(et).alias("interaction_type"),
        F.substring(F.md5(F.concat_ws("-", F.col("user_id").cast("string"),
                                      F.col("ts").cast("date").cast("string"))), 1, 12).alias("session_id"),
        F.date_format(F.col("ts"), "yyyy-MM-dd").alias("day"),
        (F.col("event_id") % 6).alias("c1"),
        ((F.col("event_id") + 1 + F.col("event_id") % 2) % 6).alias("c2"),
        (F.lit(1) + F.col("event_id") % 3).alias("n_categories"),
    )


@dataclass
class Tables:
    users: DataFrame
    products: DataFrame
    interactions: DataFrame
    complementary_map: DataFrame
    toggles: DataFrame
    resets: DataFrame
    preference_updates: DataFrame


def load(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(users(spark, sf_dir), products(spark, sf_dir), interactions(spark, sf_dir),
                  complementary_map(spark, sf_dir), toggles(spark, sf_dir), resets(spark, sf_dir),
                  preference_updates(spark, sf_dir))


def complementary_map_from_dict(spark: SparkSession, mapping: dict | None = None) -> DataFrame:
    """The (source, target) sub-category relation from a literal map (by default the reference
    catalogue's), one row per pair, in the map's order."""
    from shelfrank.functions.constants import COMPLEMENTARY_SUBCATEGORIES
    m = COMPLEMENTARY_SUBCATEGORIES if mapping is None else mapping
    rows = [(src, tgt) for src, targets in m.items() for tgt in targets]
    return spark.createDataFrame(rows, "source_sub_category string, target_sub_category string")
