"""Error measures for ratings and for classes; every one is a grouped aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAIR = ["user_id", "item_id"]


def rating_profile(ratings: DataFrame) -> DataFrame:
    return ratings.agg(
        F.count("*").alias("n_ratings"),
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("item_id").alias("n_items"),
    )


def rating_moments(df: DataFrame, value: str, prefix: str) -> DataFrame:
    """Count, mean and summed squared deviation per (user, item): all that squared errors need."""
    x = F.col(value)
    return df.groupBy(*PAIR).agg(
        F.count(x).alias(f"{prefix}_n"), F.avg(x).alias(f"{prefix}_m"), (F.var_pop(x) * F.count(x)).alias(f"{prefix}_d")
    )


def squared_error(ratings: DataFrame, predictions: DataFrame) -> DataFrame:
    """(n_pairs, sse) over the inner join of ratings and predictions on (user, item).

    Repeated pairs multiply as in a join, but both sides are reduced to one row per
    pair first, so a pair holding a large share of the rows costs one row. The error is
    a sum of terms that are never negative, so equal large numbers do not cancel.
    """
    joined = rating_moments(ratings, "rating", "r").join(rating_moments(predictions, "prediction", "p"), PAIR)
    apart = F.col("r_m") - F.col("p_m")
    sse = F.col("p_n") * F.col("r_d") + F.col("r_n") * F.col("p_d") + F.col("r_n") * F.col("p_n") * apart * apart
    return joined.agg(F.sum(F.col("r_n") * F.col("p_n")).alias("n_pairs"), F.sum(sse).alias("sse"))


def mse(ratings: DataFrame, predictions: DataFrame) -> DataFrame:
    return squared_error(ratings, predictions).select("n_pairs", (F.col("sse") / F.col("n_pairs")).alias("mse"))


def rmse_over(ratings: DataFrame, predictions: DataFrame) -> DataFrame:
    """RMSE with the number of ratings as divisor: rows without a prediction add no error but count."""
    n = ratings.agg(F.count("*")).scalar()
    return squared_error(ratings, predictions).select(
        n.alias("n_rows"), "n_pairs", F.sqrt(F.col("sse") / n).alias("rmse")
    )


def baseline(train: DataFrame, test: DataFrame, model_rmse: Column) -> DataFrame:
    """RMSE of always answering the training mean, and how much better the model is in percent."""
    mean = train.agg(F.avg("rating")).scalar()
    error = F.sqrt(F.avg((F.col("rating") - mean) * (F.col("rating") - mean)))
    return (
        test.agg(error.alias("baseline_rmse"))
        .withColumn("model_rmse", model_rmse)
        .withColumn("improvement", (F.col("baseline_rmse") - F.col("model_rmse")) / F.col("baseline_rmse") * 100)
    )


def error_rate(scored: DataFrame) -> DataFrame:
    wrong = F.sum((F.col("label") != F.col("prediction")).cast("bigint"))
    return scored.agg(
        F.count("*").alias("n_rows"),
        wrong.alias("n_wrong"),
        (wrong / F.count("*")).alias("error_rate"),
        (1 - wrong / F.count("*")).alias("accuracy"),
    )


def confusion_counts(scored: DataFrame, *by: str) -> DataFrame:
    return scored.groupBy(*by, "label", "prediction").agg(F.count("*").alias("n"))


def confusion_matrix(scored: DataFrame, classes: Sequence[str]) -> DataFrame:
    """One row per label, one column per predicted class."""
    pivoted = confusion_counts(scored).groupBy("label").pivot("prediction", list(classes)).agg(F.sum("n"))
    return pivoted.na.fill(0)


def class_report(scored: DataFrame) -> DataFrame:
    """Rates per class from the counts of (label, prediction); the counts are k x k rows."""
    counts = confusion_counts(scored)
    total = counts.agg(F.sum("n")).scalar()
    cell = counts.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("label").alias("cls"),
                    F.col("n").alias("actual"),
                    F.lit(0).cast("bigint").alias("predicted"),
                    F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit"),
                ),
                F.struct(
                    F.col("prediction").alias("cls"),
                    F.lit(0).cast("bigint").alias("actual"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("bigint").alias("hit"),
                ),
            )
        ).alias("cell")
    ).select("cell.*")
    sums = cell.groupBy("cls").agg(
        F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit")
    )
    recall = F.try_divide("hit", "actual")
    precision = F.try_divide("hit", "predicted")
    return sums.select(
        "cls",
        recall.alias("tp_rate"),
        F.try_divide(F.col("predicted") - F.col("hit"), total - F.col("actual")).alias("fp_rate"),
        precision.alias("precision"),
        recall.alias("recall"),
        F.try_divide(2 * F.col("hit"), F.col("actual") + F.col("predicted")).alias("f_measure"),
    )


def roc_area(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Rank-sum area under the ROC curve for a 0/1 label.

    Rows collapse to one per distinct score first; the running count of negatives over
    the ordered scores is built bucket by bucket.
    """
    from tidemark.operators.ordered import running_sum

    steps = scored.groupBy(score).agg(
        F.sum(F.col(label)).cast("double").alias("_pos"), F.sum(1 - F.col(label)).cast("double").alias("_neg")
    )
    summed = running_sum(steps, [], [score], F.col("_neg"), "_upto")
    wins = F.col("_pos") * (F.col("_upto") - F.col("_neg") / 2)
    return summed.agg((F.sum(wins) / (F.sum("_pos") * F.sum("_neg"))).alias("roc_area"))
