"""Filters that count what they drop, in the same pass that uses the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.text import letter_number


def keep_counted(df: DataFrame, keep: Column, name: str) -> tuple[DataFrame, Observation]:
    """The rows for which `keep` is true, and an observation of `rows` and `dropped`.

    The counts are there once an action over the result has run; they cost no pass of their own. A null counts as dropped.
    """
    seen = Observation(name)
    marked = df.withColumn("_keep", F.coalesce(keep, F.lit(False)))
    watched = marked.observe(seen, F.count("*").alias("rows"), F.count_if(~F.col("_keep")).alias("dropped"))
    return watched.where("_keep").drop("_keep"), seen


def user_numbers(captions: DataFrame, name: str = "username", out: str = "user_id") -> tuple[DataFrame, Observation]:
    """Captions with the number of their user's first letter; names without a letter are dropped and counted."""
    numbered = captions.withColumn(out, letter_number(F.col(name)))
    return keep_counted(numbered, F.col(out).isNotNull(), f"{out}-dropped")


def described(images: DataFrame, vec: str = "vec") -> tuple[DataFrame, Observation]:
    """Descriptor rows with a descriptor; rows with null or empty ones are dropped and counted."""
    return keep_counted(images, F.size(F.col(vec)) > 0, f"{vec}-dropped")
