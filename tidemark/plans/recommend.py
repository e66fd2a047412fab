"""Collaborative filtering with alternating least squares, its grid search and its top lists."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import evaluate, relational
from tidemark.operators.ordered import running_rank
from tidemark.plans import factors
from tidemark.session import via_table

# The parameter grid of the movie recommender.
GRID = [(rank, reg, iters) for rank in (8, 12) for reg in (0.1, 10.0) for iters in (10, 20)]


def one_per_pair(ratings: DataFrame) -> DataFrame:
    """Mean rating per (user, item), as a table: repeated pairs would be summed into one confidence otherwise."""
    return via_table(ratings.groupBy("user_id", "item_id").agg(F.avg("rating").alias("rating")), "rated-pairs")


class Fitted(NamedTuple):
    """Factors by dense number, in files of the shared folder."""

    users: factors.Factors
    items: factors.Factors

    @property
    def rank(self) -> int:
        return self.users.rank


class Recommender(NamedTuple):
    """Fitted factors, and the tables that number users and items (ALS only takes 32-bit numbers)."""

    model: Fitted
    users: DataFrame
    items: DataFrame


def numbered(ratings: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ratings by dense numbers, and the two tables (id, number); ids may be any 64-bit integers."""

    def index(key):
        dense = running_rank(ratings.select(key).dropna().distinct(), [], [key], "_rank")
        return via_table(dense.select(key, (F.col("_rank") - 1).cast("int").alias(f"{key}_no")), f"{key}-numbers")

    users, items = index("user_id"), index("item_id")
    coded = ratings.join(users, "user_id").join(items, "item_id")
    return via_table(coded.select("user_id_no", "item_id_no", "rating"), "coded"), users, items


class Packed(NamedTuple):
    """Numbered ratings, and as the rounds read them, once by user and once by item; all fits share them."""

    coded: DataFrame
    by_user: DataFrame
    by_item: DataFrame


def pack(coded: DataFrame) -> Packed:
    return Packed(coded, factors.packed(coded, "user_id_no", "item_id_no"), factors.packed(coded, "item_id_no", "user_id_no"))


def _fit(coded: DataFrame | Packed, rank: int, iters: int, reg: float, seed: int) -> Fitted:
    ready = coded if isinstance(coded, Packed) else pack(coded)
    return Fitted(*factors.fit(ready.by_user, ready.by_item, factors.start(ready.coded, rank, seed), iters, reg))


def fit_als(ratings: DataFrame, rank: int = 10, iters: int = 20, reg: float = 0.01, seed: int = 42) -> Recommender:
    """Explicit-feedback factors; unknown users and items get no prediction."""
    coded, users, items = numbered(ratings)
    return Recommender(_fit(coded, rank, iters, reg, seed), users, items)


def scored(fitted: Recommender, pairs: DataFrame) -> DataFrame:
    """`pairs` with a prediction where the model knows both sides; other rows drop out."""
    coded = pairs.join(fitted.users, "user_id").join(fitted.items, "item_id")
    found = factors.predicted(coded, fitted.model.users, fitted.model.items)
    return found.select(*pairs.columns, "prediction")


def predict(fitted: Recommender, pairs: DataFrame) -> DataFrame:
    """(user_id, item_id, prediction) for every pair the model knows both sides of."""
    return scored(fitted, pairs.select("user_id", "item_id"))


def pair_predictions(fitted: Recommender, ratings: DataFrame) -> DataFrame:
    return predict(fitted, ratings.select("user_id", "item_id").distinct())


def grid_search(
    train: DataFrame, validation: DataFrame, grid: Iterable[tuple[int, float, int]] = GRID, seed: int = 42, at_once: int = 4
) -> tuple[DataFrame, Recommender]:
    """One row per trial (trial, rank, reg, iters, rmse) and the model of the best trial, the first on ties.

    The trials share one numbered table; `at_once` of them run at the same time.
    """
    coded, users, items = numbered(train)
    ready = pack(coded)

    def trial(setting):
        rank, reg, iters = setting
        fitted = Recommender(_fit(ready, rank, iters, reg, seed), users, items)
        return fitted, evaluate.rmse_over(validation, pair_predictions(fitted, validation)).first()["rmse"]

    grid = list(grid)
    with ThreadPoolExecutor(at_once) as pool:
        found = list(pool.map(trial, grid))
    best = min(range(len(grid)), key=lambda k: found[k][1])
    trials = [(k + 1, grid[k][0], float(grid[k][1]), grid[k][2], found[k][1]) for k in range(len(grid))]
    rows = train.sparkSession.createDataFrame(trials, "trial int, rank int, reg double, iters int, rmse double")
    return rows, found[best][0]


def user_scores(model: Recommender, ratings: DataFrame, user: int) -> DataFrame:
    """Predicted score of every item the user has rated; repeated ratings stay repeated."""
    return predict(model, ratings.filter(F.col("user_id") == user))


def top_unrated(model: Recommender, items: DataFrame, ratings: DataFrame, user: int, n: int = 50) -> DataFrame:
    """(rank, item_id, title, prediction): the best items the user has not rated yet."""
    rated = ratings.filter(F.col("user_id") == user)
    candidates = relational.not_rated(items, rated, "item_id").withColumn("user_id", F.lit(user).cast("bigint"))
    found = scored(model, candidates.select("user_id", "item_id", "title")).drop("user_id")
    return relational.top_rows(found, [F.col("prediction").desc(), F.col("item_id")], n)
