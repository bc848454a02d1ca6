"""Result exports (S6-S12, P22): one row per key with an ordered array of item structs.

The reference collects each result to the driver and builds one JSON object. Here a key and its
list form one JSON line, written by the executors (``write_json``); the map form exists only as
those lines. Lists are bounded (5 recommendations, 8 popular, 5 similar or complementary per key).
Missing price / rating / score become 0, as the reference's export does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _zero(c: str) -> F.Column:
    return F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)


def keyed_lists(df: DataFrame, key: str, rank: str, fields: list) -> DataFrame:
    """Per ``key`` the rows' ``fields`` as an array of structs ordered by ``rank`` (rank dropped)."""
    item = F.struct(F.col(rank).alias("_rank"), F.struct(*fields).alias("item"))
    grouped = df.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("_l"))
    return grouped.select(key, F.transform("_l", lambda s: s["item"]).alias("items"))


def export_recommendations(recs: DataFrame) -> DataFrame:
    """Recommendations keyed by user."""
    return keyed_lists(recs, "user_id", "rec_rank", [
        "product_id", "product_name", "category", "sub_category", "brand", _zero("price"), _zero("avg_rating"),
        _zero("predicted_score")])


def export_popular(popular: DataFrame) -> DataFrame:
    """Popular products keyed by category; products without a category are left out (trap T4)."""
    p = popular.filter(F.col("category").isNotNull())
    return keyed_lists(p, "category", "rank", [
        "product_id", "product_name", "brand", _zero("price"), _zero("avg_rating"),
        F.coalesce(F.col("popularity_score").cast("bigint"), F.lit(0)).alias("popularity_score")])


def export_similar(similar: DataFrame) -> DataFrame:
    """Similar products keyed by source product (order = rank; engagement and rank dropped)."""
    return keyed_lists(similar, "source_product_id", "sim_rank", [
        F.col("similar_product_id").alias("product_id"), F.col("similar_product_name").alias("product_name"),
        "category", "brand", _zero("price"), _zero("avg_rating")])


def export_complementary(comp: DataFrame) -> DataFrame:
    """Complementary products keyed by source product."""
    return keyed_lists(comp, "source_product_id", "comp_rank", [
        F.col("comp_product_id").alias("product_id"), F.col("comp_product_name").alias("product_name"),
        "category", "sub_category", "brand", _zero("price"), _zero("avg_rating")])


def export_top_rated(top: DataFrame) -> DataFrame:
    """The top-rated list, in rank order."""
    return top.select("rank", "product_id", "product_name", "category", "brand", _zero("price"), _zero("avg_rating"),
                      F.coalesce(F.col("rating_count").cast("bigint"), F.lit(0)).alias("rating_count"))


def catalog_export(products: DataFrame) -> DataFrame:
    """The catalogue's 9 exported columns (no stock)."""
    return products.select("product_id", "product_name", "category", "sub_category", "brand", "price", "price_range",
                           "avg_rating", "rating_count")


def to_json_lines(df: DataFrame) -> DataFrame:
    """Each row as one JSON text (a column; still distributed)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def item_ids(keyed: DataFrame, key: str) -> DataFrame:
    """A keyed export with its list flattened to the text of the item ids (for comparisons)."""
    return keyed.select(key, F.array_join(F.transform("items", lambda s: s["product_id"].cast("string")), ",")
                        .alias("item_ids"))
