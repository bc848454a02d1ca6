"""Exploratory aggregates and the run summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.functions.columns import round_half_up


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """A1-A3: rows per value of ``column``, most frequent first (ties by value)."""
    return df.groupBy(column).count().orderBy(F.desc("count"), F.asc(column))


def category_profile(products: DataFrame) -> DataFrame:
    """A4: per category the mean price and mean rating (2 decimals, half up) and the product count."""
    return (products.groupBy("category")
            .agg(round_half_up(F.avg("price"), 2).alias("avg_price"),
                 round_half_up(F.avg("avg_rating"), 2).alias("avg_rating"),
                 F.count("*").alias("product_count"))
            .orderBy(F.desc("avg_price"), F.asc("category")))


def score_stats(matrix: DataFrame, column: str = "final_score") -> DataFrame:
    """Global min, max, mean and sample standard deviation of the matrix score (one row)."""
    c = F.col(column)
    return matrix.agg(F.min(c).alias("min_score"), F.max(c).alias("max_score"),
                      round_half_up(F.mean(c), 2).alias("mean_score"),
                      round_half_up(F.stddev_samp(c), 2).alias("stddev_score"))


def run_summary(users: DataFrame, products: DataFrame, raw_interactions: DataFrame,
                interactions: DataFrame, matrix: DataFrame) -> DataFrame:
    """A10: the row counts of a run as (metric, value) rows; one aggregate per table, no driver loop."""
    def count(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias("value")).select(F.lit(name).alias("metric"), "value")

    pairs = matrix.agg(F.count("*").alias("matrix_pairs"), F.countDistinct("user_id").alias("matrix_users"))
    return (count(users, "users").unionByName(count(products, "products"))
            .unionByName(count(raw_interactions, "raw_interactions")).unionByName(count(interactions, "interactions"))
            .unionByName(pairs.unpivot([], ["matrix_pairs", "matrix_users"], "metric", "value")))


def stored_summary(figures: dict[str, int], raw_interactions: DataFrame, matrix: DataFrame) -> DataFrame:
    """A10 of a run whose stored tables were counted by their writes (users, products, interactions, matrix_pairs): only the raw
    log, which the run does not store, and the user ids of the matrix are read."""
    spark = matrix.sparkSession
    known = spark.createDataFrame([(name, int(figures[name])) for name in ("users", "products", "interactions", "matrix_pairs")],
                                  "metric string, value long")
    raw = raw_interactions.agg(F.count("*").alias("value")).select(F.lit("raw_interactions").alias("metric"), "value")
    users = matrix.agg(F.countDistinct("user_id").alias("value")).select(F.lit("matrix_users").alias("metric"), "value")
    return known.unionByName(raw).unionByName(users)


def model_summary(metrics: DataFrame, recommendations: DataFrame) -> DataFrame:
    """A10, the model's rows: RMSE and MAE (6 decimals) of one metrics row, and the users with recommendations."""
    served = recommendations.agg(F.countDistinct("user_id").cast("double").alias("users_served"))
    return error_summary(metrics).unionByName(served.unpivot([], ["users_served"], "metric", "value"))


def error_summary(metrics: DataFrame) -> DataFrame:
    """RMSE and MAE (6 decimals) of one metrics row as (metric, value) rows."""
    errors = metrics.select(round_half_up("rmse", 6).alias("rmse"), round_half_up("mae", 6).alias("mae"))
    return errors.unpivot([], ["rmse", "mae"], "metric", "value")
