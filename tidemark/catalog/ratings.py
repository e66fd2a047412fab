"""Recommendation queries on the purchase ratings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.operators import evaluate
from tidemark.plans import recommend
from tidemark.session import via_table
from tidemark.sources.tables import RATINGS_SQL, ratings, table


def rating_table(spark, folder):
    """The ratings, joined once, for queries that read them several times."""
    return via_table(ratings(spark, folder), "ratings")


@query("als_train_mse")
def als_train_mse(spark, folder):
    rows = recommend.one_per_pair(ratings(spark, folder))
    model = recommend.fit_als(rows, rank=10, iters=20, reg=0.01)
    return evaluate.mse(rows, recommend.pair_predictions(model, rows))


@query("als_grid")
def als_grid(spark, folder):
    """Validation error per trial; the best model's test error and its gain over the mean."""
    rows = rating_table(spark, folder)
    train, validation = rows.filter(F.col("digit") < 6), rows.filter(F.col("digit").between(6, 7))
    test = rows.filter(F.col("digit") >= 8)
    trials, model = recommend.grid_search(recommend.one_per_pair(train), validation)
    error = evaluate.rmse_over(test, recommend.pair_predictions(model, test)).first()["rmse"]
    known = rows.filter(F.col("digit") < 8)
    base = evaluate.baseline(known, test, F.lit(error)).first()
    return trials.withColumns(
        {
            "test_rmse": F.lit(error),
            "baseline_rmse": F.lit(base.baseline_rmse),
            "improvement": F.lit(base.improvement),
        }
    )


@query("als_user_scores")
def als_user_scores(spark, folder):
    rows = rating_table(spark, folder)
    model = recommend.fit_als(recommend.one_per_pair(rows), rank=12, iters=20, reg=0.1)
    return recommend.user_scores(model, rows, 1)


@query("als_top50")
def als_top50(spark, folder):
    rows = rating_table(spark, folder)
    model = recommend.fit_als(recommend.one_per_pair(rows), rank=12, iters=20, reg=0.1)
    items = table(spark, folder, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))
    return recommend.top_unrated(model, items, rows, 0)


@query(
    "als_cold_start",
    f"""WITH {RATINGS_SQL}, train AS (SELECT * FROM ratings WHERE digit < 6), v AS (SELECT * FROM ratings WHERE digit >= 6)
    SELECT user_id, item_id, count(*) AS n FROM v
    WHERE user_id NOT IN (SELECT user_id FROM train) OR item_id NOT IN (SELECT item_id FROM train) GROUP BY 1, 2""",
)
def als_cold_start(spark, folder):
    """The held-out pairs that factors fitted on the training split give no prediction for."""
    rows = rating_table(spark, folder)
    model = recommend.fit_als(recommend.one_per_pair(rows.filter(F.col("digit") < 6)), rank=8, iters=10, reg=0.1)
    pairs = rows.filter(F.col("digit") >= 6).groupBy("user_id", "item_id").agg(F.count("*").alias("n"))
    return pairs.join(recommend.predict(model, pairs), ["user_id", "item_id"], "left_anti")
