"""Joins, set operations, rankings and catalog building on plain tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import running_rank
from tidemark.session import via_table

SHUFFLE_PRIME = 1_000_003


def lookup(rows: DataFrame, dictionary: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join a dictionary that has one row per key.

    Adaptive execution decides by the measured bytes whether the dictionary is broadcast, and
    splits the slices of frequent keys where it is not.
    """
    return rows.join(dictionary, key, how)


def not_rated(items: DataFrame, rated: DataFrame, key: str) -> DataFrame:
    """Candidate items: those a user has no rating for."""
    return items.join(rated.select(key).distinct(), key, "left_anti")


def matching_names(recommended: DataFrame, predicted: DataFrame, name: str, distinct: bool = False) -> DataFrame:
    """How often each name is both recommended and predicted.

    Every (recommendation, prediction) pair with one name counts once, so the number of
    pairs is the product of both counts; the pairs themselves are never built.
    """
    left = recommended.groupBy(name).agg(F.count("*").alias("_recommended"))
    right = predicted.groupBy(name).agg(F.count("*").alias("_predicted"))
    pairs = F.lit(1).cast("bigint") if distinct else F.col("_recommended") * F.col("_predicted")
    return left.join(right, name).select(name, pairs.alias("n_matches"))


def row_numbers(df: DataFrame, order: str, out: str) -> DataFrame:
    """1-based position of every row along a unique numeric column, over the whole table."""
    return running_rank(df, [], [order], out)


def zipped(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Pair the n-th row of one table with the n-th row of the other."""
    return row_numbers(left, left_key, "position").join(row_numbers(right, right_key, "position"), "position")


def catalog_product(items: DataFrame, brands: DataFrame, item: str, brand: str) -> DataFrame:
    """Number every item of every brand, brand by brand (seq, item, brand).

    Both lists are ranked by ranges, and each item row is then repeated once per brand position, which
    turns the product into an equi-join on the position.
    """
    left = via_table(running_rank(items.select(item).distinct(), [], [item], "item_pos"), "items")
    right = via_table(running_rank(brands.select(brand).distinct(), [], [brand], "brand_pos"), "brands")
    n_items = left.agg(F.max("item_pos")).scalar()
    n_brands = right.agg(F.max("brand_pos")).scalar()
    return (
        left.withColumn("brand_pos", F.explode(F.sequence(F.lit(1).cast("bigint"), n_brands)))
        .join(right, "brand_pos")
        .select(((F.col("brand_pos") - 1) * n_items + F.col("item_pos")).alias("seq"), item, brand)
    )


def top_rows(df: DataFrame, order: Sequence[Column], n: int, out: str = "rank") -> DataFrame:
    """The first n rows by `order`, numbered; only those n rows meet in one task."""
    head = df.orderBy(*order).limit(n)
    return head.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def top_rows_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, out: str = "rank") -> DataFrame:
    """First n rows of each group; the rank filter lets Spark cut each group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(out, rank).filter(F.col(out) <= n).withColumn(out, F.col(out).cast("bigint"))


def best_trial(trials: DataFrame, error: str, number: str) -> DataFrame:
    """The trial with the smallest error, the earliest one on ties."""
    every = F.struct(*trials.columns)
    return trials.agg(F.min_by(every, F.struct(error, number)).alias("_best")).select("_best.*")


def stratified_folds(df: DataFrame, label: str, key: str, folds: int, out: str = "fold") -> DataFrame:
    """Deal the rows of each label to folds in a repeatable shuffled order, sizes equal to within one."""
    # The remainder comes first: a large id times the factor would not fit 64 bits.
    shuffled = df.withColumn("_h", F.pmod(F.pmod(key, F.lit(SHUFFLE_PRIME)) * 7919, F.lit(SHUFFLE_PRIME)))
    numbered = running_rank(shuffled, [label], ["_h", key], "_rank")
    return numbered.withColumn(out, F.pmod(F.col("_rank") - 1, F.lit(folds))).drop("_h", "_rank")
