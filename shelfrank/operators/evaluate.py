"""Model evaluation (A12-A14, M6) and the error formulas on fixed predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dot(a, b) -> F.Column:
    """Dot product of two array<double> columns, JVM side."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def error_metrics(pairs: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """A12 + A13: RMSE and MAE over (actual, predicted) rows, and their count."""
    d = F.col(actual) - F.col(predicted)
    return pairs.agg(F.sqrt(F.avg(d * d)).alias("rmse"), F.avg(F.abs(d)).alias("mae"),
                     F.count("*").alias("n_test"))


def test_predictions(split: DataFrame, user_factors: DataFrame, item_factors: DataFrame) -> DataFrame:
    """Predicted score w_u . h_p of every held-out cell (is_train = false)."""
    test = split.filter(~F.col("is_train")).select("user_id", "product_id", F.col("final_score").alias("actual"))
    return (test.join(user_factors.select("user_id", F.col("factors").alias("w")), "user_id")
            .join(item_factors.select("product_id", F.col("factors").alias("h")), "product_id")
            .select("user_id", "product_id", "actual", dot(F.col("w"), F.col("h")).alias("predicted")))


def reconstruction_error(split: DataFrame, user_factors: DataFrame, item_factors: DataFrame, k: int) -> DataFrame:
    """A14 as one row: sqrt(sum over all users x products of (r - w.h)^2), r = 0 outside the training cells.
    Only observed cells are joined; the rest comes from the k x k Grams, sum (w.h)^2 = trace(W'W H'H)."""
    def gram(f: DataFrame) -> list:
        return [F.sum(F.col("factors")[i] * F.col("factors")[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]

    train = split.filter("is_train").select("user_id", "product_id", F.col("final_score").alias("r"))
    seen = (train.join(user_factors.select("user_id", F.col("factors").alias("w")), "user_id")
            .join(item_factors.select("product_id", F.col("factors").alias("h")), "product_id")
            .agg(F.sum(F.col("r") * F.col("r") - 2 * F.col("r") * dot(F.col("w"), F.col("h"))).alias("s")))
    gw, gh = user_factors.agg(*gram(user_factors)).first(), item_factors.agg(*gram(item_factors)).first()
    both = sum((1 if i == j else 2) * (gw[f"g{i}_{j}"] or 0.0) * (gh[f"g{i}_{j}"] or 0.0) for i in range(k) for j in range(i, k))
    return seen.select(F.sqrt(F.greatest(F.lit(0.0), F.coalesce("s", F.lit(0.0)) + F.lit(both))).alias("reconstruction_error"))


def model_metrics(spark: SparkSession, split: DataFrame, model) -> DataFrame:
    """M6: RMSE and MAE on the held-out cells, plus the training reconstruction error (A14),
    iterations run and final objective, as one row. Held-out cells were 0 in training (trap T5)."""
    m = error_metrics(test_predictions(split, model.user_factors, model.item_factors))
    final_loss = model.objective
    return m.select("rmse", "mae", "n_test",
                    F.lit(float(model.reconstruction_error)).alias("reconstruction_error"),
                    F.lit(int(model.iterations)).alias("iterations"),
                    F.lit(float(final_loss)).alias("final_loss"))


def user_mean_predictions(split: DataFrame) -> DataFrame:
    """A fixed, SQL-expressible predictor for the error formulas: a held-out cell is predicted by the
    mean training score of its user (0 when the user has none)."""
    means = split.filter("is_train").groupBy("user_id").agg(F.avg("final_score").alias("user_mean"))
    test = split.filter(~F.col("is_train"))
    return (test.join(means, "user_id", "left")
            .select("user_id", "product_id", F.col("final_score").alias("actual"),
                    F.coalesce("user_mean", F.lit(0.0)).alias("predicted")))
