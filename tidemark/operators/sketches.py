"""Distinct counts that merge: sketches stored per day, unions of any days without the rows.

A sketch is a HyperLogLog of 2^lg registers (a few kilobytes whatever it has seen); its estimate is off by about
1.04 / sqrt(2^lg) at one standard error. Null values do not count; a group without values estimates 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG = 12


def standard_error(lg: int = LG) -> float:
    return 1.04 / math.sqrt(1 << lg)


def distinct_sketches(df: DataFrame, by: Sequence[str], columns: Sequence[str], lg: int = LG) -> DataFrame:
    """One row per group with the number of rows and a sketch of every column, to be stored."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"), *[F.hll_sketch_agg(c, F.lit(lg)).alias(c) for c in columns]
    )


def union(sketches: DataFrame, by: Sequence[str | Column], columns: Sequence[str]) -> DataFrame:
    """Coarser groups from stored sketches; the rows they were made from are not read again."""
    return sketches.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), *[F.hll_union_agg(c, F.lit(True)).alias(c) for c in columns]
    )


def estimates(sketches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The sketches replaced by their distinct counts."""
    return sketches.withColumns({c: F.coalesce(F.hll_sketch_estimate(c), F.lit(0)) for c in columns})
