"""The sparse user-product matrix and its train/test split.

The dense users x products matrix of the reference is never built: the matrix is a DataFrame of
(user_id, product_id, score) triplets, and a missing pair means 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.functions import constants as C


def user_product_matrix(interactions: DataFrame, score_weight: float = C.SCORE_WEIGHT,
                        rating_weight: float = C.RATING_WEIGHT) -> DataFrame:
    """A5 + A6: per (user, product) the summed score, event count, best rating, sorted set of types,
    and the fused ``final_score`` = score_weight * total + rating_weight * max_rating (total alone when
    no rating exists). Partial aggregation happens before the shuffle, so a hot user or product sends
    one partial row per task."""
    agg = (interactions.groupBy("user_id", "product_id")
           .agg(F.sum("interaction_score").cast("bigint").alias("total_score"),
                F.count("*").alias("interaction_count"),
                F.max("rating").alias("max_rating"),
                F.array_sort(F.collect_set("interaction_type")).alias("interaction_types")))
    fused = F.when(F.col("max_rating").isNotNull(),
                   F.col("total_score") * F.lit(float(score_weight)) + F.col("max_rating") * F.lit(float(rating_weight))
                   ).otherwise(F.col("total_score").cast("double"))
    return agg.withColumn("final_score", fused)


def matrix_input(matrix: DataFrame) -> DataFrame:
    """The (user, product, score) triplets of the model, rows with any null dropped."""
    return matrix.select("user_id", "product_id", "final_score").na.drop()


def interaction_pivot(interactions: DataFrame, types: Sequence[str] = tuple(C.INTERACTION_WEIGHTS)) -> DataFrame:
    """Per user the summed score for each listed interaction type, missing -> 0. The value list
    is given, so Spark needs no extra pass to find the pivot columns."""
    piv = interactions.groupBy("user_id").pivot("interaction_type", list(types)).agg(
        F.sum("interaction_score").cast("bigint"))
    return piv.fillna(0, subset=list(types))


def split_bucket(user="user_id", product="product_id", seed: int = C.RANDOM_SEED) -> F.Column:
    """0..99 from md5(user|product|seed): the same for every partitioning and in every engine."""
    h = F.md5(F.concat_ws("|", F.col(user).cast("string"), F.col(product).cast("string"), F.lit(str(seed))))
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint"), F.lit(100))


def train_test_split(entries: DataFrame, train_fraction: float = C.TRAIN_FRACTION,
                     seed: int = C.RANDOM_SEED) -> DataFrame:
    """M1: mark each observed entry train (bucket < 100 * fraction) or test. Test entries stay in the
    table: the model sees them as 0, not as missing, as in the reference."""
    cut = int(round(train_fraction * 100))
    return entries.withColumn("is_train", split_bucket(seed=seed) < F.lit(cut))


def split_counts(split: DataFrame) -> DataFrame:
    """Numbers of training and test entries."""
    return split.agg(F.count_if(F.col("is_train")).alias("train_entries"),
                     F.count_if(~F.col("is_train")).alias("test_entries"))


def matrix_shape(matrix: DataFrame) -> DataFrame:
    """Distinct users, distinct products and entries of the matrix."""
    return matrix.agg(F.countDistinct("user_id").alias("n_users"),
                      F.countDistinct("product_id").alias("n_products"),
                      F.count("*").alias("n_entries"))
