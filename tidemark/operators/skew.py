"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.001
SALTS = 32
MIN_HOT_ROWS = 100_000


def hot_among(counts: DataFrame, key: str, n: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys holding at least `share` of all rows, given rows per key; never more than 1/share keys."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.filter(F.col(n) >= F.greatest(total * share, F.lit(MIN_HOT_ROWS))).select(key)


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    return hot_among(df.groupBy(key).agg(F.count("*").alias("_n")), key, "_n", share)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: Column,
    how: str = "inner",
    salts: int = SALTS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join where `left` may be skewed on `key` and `right` holds few rows per key.

    Rows of a hot key on the left are dealt to `salts` sub-keys by a hash of
    `spread_by`; only the matching right rows are repeated, once per sub-key. The
    broadcast list of hot keys is bounded by 1 / HOT_SHARE entries; a caller that has
    counted the keys already passes its own list.
    """
    if how not in ("inner", "left"):
        raise ValueError("a salted join repeats right rows, so only inner and left are exact")
    marked = F.broadcast((hot_keys(left, key) if hot is None else hot).withColumn("_hot", F.lit(True)))
    dealt = left.join(marked, key, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread_by), F.lit(salts))).otherwise(F.lit(0).cast("bigint"))
    )
    repeated = right.join(marked, key, "left").withColumn(
        "_salt",
        F.explode(F.expr(f"sequence(0L, CASE WHEN _hot THEN {salts - 1}L ELSE 0L END)")),
    )
    return dealt.drop("_hot").join(repeated.drop("_hot"), [key, "_salt"], how).drop("_salt")
