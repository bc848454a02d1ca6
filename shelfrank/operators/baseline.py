"""Baseline recommender (M8, with A19, W11, U1, U2): the reference's stand-in for the model.

Per user with interactions: the 2 best-rated products of the user's top category that are not
among the user's top 15, then 3 pseudo-random products not among the top 15, first occurrence
wins, padded to 5 from the same pseudo-random order over the whole catalogue.

Bounded form: a category needs only its 2 + 15 best-rated products (at most 15 can be excluded),
and the pseudo-random order is a walk of 2 + 15 + 3 consecutive md5 positions of the catalogue
from a per-user hashed start. A user's top products, category candidates and walk are short arrays of
one row, so choosing among them is array work without further joins or shuffles; nothing pairs a user
with the whole catalogue.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.functions import constants as C
from shelfrank.operators.feed import category_index, user_top_category, user_top_products
from shelfrank.operators.ordering import hashed_offset, md5_positions, walk


def baseline_recommender(interactions: DataFrame, products: DataFrame, n: int = C.RECOMMENDATIONS_PER_USER,
                         top_n: int = C.BASELINE_TOP_PRODUCTS, category_picks: int = C.BASELINE_CATEGORY_PICKS,
                         other_picks: int = C.BASELINE_OTHER_PICKS) -> DataFrame:
    top_ranked = user_top_products(interactions, top_n)
    users = top_ranked.groupBy("user_id").agg(F.collect_list("product_id").alias("tops"))
    # A user without a known top category gets a category picked by hash.
    idx = category_index(products)
    n_cat = idx.select(F.count("*")).scalar()
    topcat = user_top_category(top_ranked, products).select("user_id", "top_category")
    ucat = (users.withColumn("ci", hashed_offset(["user_id"], n_cat))
            .join(idx.select("ci", F.col("category").alias("fallback_category")), "ci", "left")
            .join(topcat, "user_id", "left")
            .select("user_id", "tops", F.coalesce("top_category", "fallback_category").alias("category")))

    def ordered(place: str):
        """Product ids of a group in the order of ``place``."""
        return F.transform(F.array_sort(F.collect_list(F.struct(place, "product_id"))), lambda x: x["product_id"])

    def outside(ids, *lists):
        return F.filter(ids, lambda x: ~functools.reduce(lambda a, b: a | b, [F.array_contains(l, x) for l in lists]))

    # Source 0: best-rated of the top category, not in the user's top products.
    wcat = Window.partitionBy("category").orderBy(F.desc("avg_rating"), F.asc("product_id"))
    best = (products.filter(F.col("category").isNotNull())
            .withColumn("_r", F.row_number().over(wcat)).filter(F.col("_r") <= category_picks + top_n)
            .groupBy("category").agg(ordered("_r").alias("best")))
    # Source 1: a per-user walk over the catalogue in md5 order, skipping the top products and the
    # category picks (first occurrence wins), first ``other_picks``. Source 2 pads from the same walk.
    steps = category_picks + top_n + other_picks
    positioned = md5_positions(products.select("product_id"), [], "product_id")
    walked = (walk(users.select("user_id"), positioned, [], ["user_id"], steps)
              .groupBy("user_id").agg(ordered("step").alias("walk")))
    none = F.array().cast("array<bigint>")
    rows = (ucat.join(best, "category", "left").join(walked, "user_id", "left")
            .withColumns({"best": F.coalesce("best", none), "walk": F.coalesce("walk", none)})
            .withColumn("picks", F.slice(outside(F.col("best"), F.col("tops")), 1, category_picks))
            .withColumn("others", F.slice(outside(F.col("walk"), F.col("tops"), F.col("picks")), 1, other_picks))
            .withColumn("pad", outside(F.col("walk"), F.col("picks"), F.col("others"))))

    def tagged(name: str, src: int):
        return F.transform(name, lambda x: F.struct(x.alias("product_id"), F.lit(src).alias("src")))

    ranked = (rows.select("user_id", F.posexplode(F.slice(F.concat(tagged("picks", 0), tagged("others", 1), tagged("pad", 2)), 1, n)).alias("at", "r"))
              .select("user_id", (F.col("at") + 1).alias("rec_rank"), F.col("r.product_id").alias("product_id"), F.col("r.src").alias("src")))
    names = F.array(F.lit("category"), F.lit("random"), F.lit("pad"))
    fields = ["product_name", "category", "sub_category", "brand", "price", "avg_rating", "rating_count", "price_range"]
    return (ranked.join(products.select("product_id", *fields), "product_id", "left")
            .select("user_id", "rec_rank", "product_id", F.element_at(names, F.col("src") + 1).alias("source"), *fields))
