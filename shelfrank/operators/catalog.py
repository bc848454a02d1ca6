"""Catalogue lists: popularity, popular per category, engagement, similar, complementary, top rated,
search and category listings.

Every ranking ends with ``product_id`` ascending, so results repeat (trap T3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.functions import constants as C


def product_popularity(interactions: DataFrame) -> DataFrame:
    """A8 (and A9, O5): per product the summed score, the event count and the distinct users.

    One partial + final aggregation; ``total_engagement`` of the similar/complementary lists is the
    same sum, so one shuffle serves both.
    """
    return (interactions.groupBy("product_id")
            .agg(F.sum("interaction_score").cast("bigint").alias("popularity_score"),
                 F.count("*").alias("total_interactions"),
                 F.countDistinct("user_id").alias("unique_users")))


def popularity_sketches(interactions: DataFrame) -> DataFrame:
    """A8 with mergeable distinct users: as ``product_popularity``, but with an HLL sketch of the users (Spark's, of 4,096 registers). A
    sketch has some KB whatever the number of users, and sketches of parts of a log can be merged."""
    return (interactions.groupBy("product_id")
            .agg(F.sum("interaction_score").cast("bigint").alias("popularity_score"), F.count("*").alias("total_interactions"),
                 F.hll_sketch_agg(F.col("user_id").cast("bigint")).alias("users")))


def merge_sketches(*parts: DataFrame) -> DataFrame:
    """The sketches of several parts of a log (days, regions) as those of the whole; no part is read again."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("product_id").agg(F.sum("popularity_score").cast("bigint").alias("popularity_score"), F.sum("total_interactions").cast("bigint").alias("total_interactions"),
                                          F.hll_union_agg("users").alias("users"))


def estimated_users(sketches: DataFrame) -> DataFrame:
    """``product_popularity``'s columns, with unique_users estimated (standard error about 1.6 %; next to none below some hundred users)."""
    return sketches.select("product_id", "popularity_score", "total_interactions", F.hll_sketch_estimate("users").alias("unique_users"))


def engagement_of(products: DataFrame, popularity: DataFrame) -> DataFrame:
    """J3, P13 from a popularity table: the catalogue with ``total_engagement`` (0 without interactions)."""
    eng = popularity.select("product_id", F.col("popularity_score").alias("total_engagement"))
    return products.join(eng, "product_id", "left").fillna(0, subset=["total_engagement"])


def popular_by_category(products: DataFrame, interactions: DataFrame, k: int = C.POPULAR_PER_CATEGORY) -> DataFrame:
    """W1 with J2: top ``k`` products by popularity per category.

    Products with interactions but no catalogue row keep a null category and are ranked as their own
    group (trap T4); the export drops them. The popularity table has one row per product, and the
    row_number <= k filter runs as a WindowGroupLimit, partial before the shuffle on category.
    """
    return rank_popular(product_popularity(interactions), products, k)


def rank_popular(popularity: DataFrame, products: DataFrame, k: int = C.POPULAR_PER_CATEGORY) -> DataFrame:
    """W1 + J2 on a popularity table (product_id, popularity_score, total_interactions, unique_users)."""
    pop = popularity.join(
        products.select("product_id", "product_name", "category", "brand", "price", "avg_rating"),
        "product_id", "left")
    w = Window.partitionBy("category").orderBy(F.desc("popularity_score"), F.asc("product_id"))
    return (pop.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("category", "rank", "product_id", "product_name", "brand", "price", "avg_rating",
                    "popularity_score", "total_interactions", "unique_users"))


def product_engagement(products: DataFrame, interactions: DataFrame) -> DataFrame:
    """J3 + A9 + P13: the catalogue with each product's summed interaction score (0 without one)."""
    eng = interactions.groupBy("product_id").agg(F.sum("interaction_score").cast("bigint").alias("total_engagement"))
    return products.join(eng, "product_id", "left").fillna(0, subset=["total_engagement"])


def _quality_order():
    return [F.desc("avg_rating"), F.desc("engagement"), F.asc("product_id")]


def _stats(products_with_stats: DataFrame) -> DataFrame:
    return products_with_stats.select("product_id", "product_name", "category", "sub_category", "brand", "price",
                                      "avg_rating", F.col("total_engagement").alias("engagement"))


def _top_lists(candidates: DataFrame, key: str, k: int) -> DataFrame:
    """(key, tops): the best k + 1 candidates of each ``key`` in order, as one array. It has k + 1 entries at most whatever the
    group's size (a WindowGroupLimit, partial before the shuffle)."""
    w = Window.partitionBy(key).orderBy(*_quality_order())
    best = candidates.withColumn("_grp_rank", F.row_number().over(w)).filter(F.col("_grp_rank") <= k + 1)
    entry = F.struct("_grp_rank", *[c for c in candidates.columns if c != key])
    return best.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("tops"))


#: Parts of a group's sources in the list joins: the one list row of a group is copied to each part, so a
#: sub-category with half of the catalogue is joined in as many tasks.
SALTS = 16


def _salted(sources: DataFrame) -> DataFrame:
    return sources.withColumn("_salt", F.pmod(F.xxhash64("source_product_id"), F.lit(SALTS)).cast("int"))


def _copied(lists: DataFrame) -> DataFrame:
    return lists.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _list_rows(sources: DataFrame, lists: DataFrame, key: str, k: int, rank: str) -> DataFrame:
    """The first ``k`` entries of each source's list but for itself, with their rank. All sources of a group share one list, so
    the join makes one row for each source, and no source is sorted or shuffled after it."""
    own = F.slice(F.filter("tops", lambda x: x["product_id"] != F.col("source_product_id")), 1, k)
    rows = _salted(sources).join(_copied(lists), [key, "_salt"]).select("source_product_id", "source_product_name", F.posexplode(own).alias("_pos", "e"))
    return rows.withColumn(rank, (F.col("_pos") + 1).cast("int"))


def _candidates(stats: DataFrame) -> DataFrame:
    return stats.filter(F.col("sub_category").isNotNull())


def similar_products(products_with_stats: DataFrame, k: int = C.SIMILAR_PER_PRODUCT) -> DataFrame:
    """J4 + W2 (rewrite O1): for each product the top ``k`` other products of its sub-category by
    avg_rating desc, engagement desc, product_id asc.

    Equal to ranking the self-join (same sub-category, other id), but a sub-category's top k + 1 are found once and all
    its products share them: a product drops itself from the list and takes the first k.
    """
    stats = _stats(products_with_stats)
    lists = _top_lists(_candidates(stats), "sub_category", k)
    src = stats.select(F.col("product_id").alias("source_product_id"), F.col("product_name").alias("source_product_name"), "sub_category")
    rows = _list_rows(src, lists, "sub_category", k, "sim_rank")
    return rows.select("source_product_id", "source_product_name", F.col("e.product_id").alias("similar_product_id"), F.col("e.product_name").alias("similar_product_name"),
                       "e.category", "e.brand", "e.price", "e.avg_rating", "e.engagement", "sim_rank")


def complementary_products(products_with_stats: DataFrame, comp_map: DataFrame,
                           k: int = C.COMPLEMENTARY_PER_PRODUCT) -> DataFrame:
    """J5 + J6 + W3 (rewrite O2): for each product the top ``k`` products of its complementary
    sub-categories by avg_rating desc, engagement desc, product_id asc; the product itself is never
    its own complement.

    What a product is offered depends on its sub-category only: each target group is cut to k + 1, the tops of a source
    sub-category's targets are ranked once and cut to k + 1 again, and all its products share that list.
    """
    stats = _stats(products_with_stats)
    w = Window.partitionBy("sub_category").orderBy(*_quality_order())
    tops = _candidates(stats).withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k + 1).drop("_n")
    targets = comp_map.select("source_sub_category", F.col("target_sub_category").alias("sub_category")).distinct()
    lists = _top_lists(tops.join(targets, "sub_category"), "source_sub_category", k)
    src = stats.select(F.col("product_id").alias("source_product_id"), F.col("product_name").alias("source_product_name"),
                       F.col("sub_category").alias("source_sub_category"))
    rows = _list_rows(src, lists, "source_sub_category", k, "comp_rank")
    return rows.select("source_product_id", "source_product_name", F.col("e.product_id").alias("comp_product_id"), F.col("e.product_name").alias("comp_product_name"),
                       "e.category", "e.sub_category", "e.brand", "e.price", "e.avg_rating", "e.engagement", "comp_rank")


def top_rated(products: DataFrame, n: int = C.TOP_RATED_COUNT, min_ratings: int = C.TOP_RATED_MIN_RATINGS) -> DataFrame:
    """W4 + P10: the ``n`` best-rated products with at least ``min_ratings`` ratings, ordered by
    avg_rating desc, rating_count desc, product_id asc. The threshold is pushed to the scan; sort +
    limit runs as TakeOrderedAndProject (a per-task top n, then one merge of n rows per task)."""
    best = (products.filter(F.col("rating_count") >= min_ratings)
            .orderBy(F.desc("avg_rating"), F.desc("rating_count"), F.asc("product_id")).limit(n)
            .select("product_id", "product_name", "category", "brand", "price", "avg_rating", "rating_count"))
    # The window sees the n rows left after the limit only.
    w = Window.orderBy(F.desc("avg_rating"), F.desc("rating_count"), F.asc("product_id"))
    return best.withColumn("rank", F.row_number().over(w))


def product_search(products: DataFrame, query: str, categories=None) -> DataFrame:
    """Products whose name, brand, category or sub-category contains the trimmed, lower-cased
    query (null-safe), optionally within a list of categories. An empty query gives no rows."""
    q = (query or "").strip().lower()
    if not q:
        return products.filter(F.lit(False))
    fields = ["product_name", "brand", "category", "sub_category"]
    hit = None
    for f in fields:
        c = F.coalesce(F.lower(F.col(f)).contains(F.lit(q)), F.lit(False))
        hit = c if hit is None else (hit | c)
    out = products.filter(hit)
    if categories is not None:
        out = out.filter(F.col("category").isin(list(categories)))
    return out


def category_listing(products: DataFrame, category: str | None = None) -> DataFrame:
    """The products of a category (all categories when None) with the category's product count.
    The count is an aggregate joined back (tiny per-category table), not a window over a category
    that may hold a third of the catalogue."""
    base = products if category is None else products.filter(F.col("category") == category)
    counts = base.groupBy("category").agg(F.count("*").alias("category_count"))
    return base.select("product_id", "product_name", "category", "price", "avg_rating").join(counts, "category")


def similar_for_ids(similar: DataFrame, ids, column: str = "source_product_id") -> DataFrame:
    """The lists of the given source products only. ``ids`` is a short list (an IN filter, pushed
    down when the lists are read from a file) or a table whose first column holds them (a semi join)."""
    if isinstance(ids, DataFrame):
        return similar.join(ids.select(F.col(ids.columns[0]).alias(column)), column, "left_semi")
    return similar.filter(F.col(column).isin(list(ids)))
