"""Running values and ranks without putting a whole group into one task.

A plain window function sorts each group in a single task. Here the rows are dealt by ranges of
(group, order), so a large group spans as many slices as its share of the rows asks for, whatever
its order values look like. Each slice is scanned by one task, and the totals of a group's earlier
slices, one small row per group and slice, are added afterwards. Null groups and null order values
are kept, as a window function keeps them (nulls sort first).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import via_table


def sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows as a table with `_slice`: contiguous, about equally large ranges of (keys, order).

    Written once, so that later steps agree on the slices and the input is evaluated once.
    """
    dealt = df.repartitionByRange(*keys, *order)
    return via_table(dealt.withColumn("_slice", F.spark_partition_id()), "slices")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add running sums and latest non-null values, all in one pass over one timeline.

    `sums` and `lasts` map a new column to the value it runs over; `order` must be unique in a group.
    A running sum is null until the group has had a non-null value.
    """
    keys, sums, lasts = list(keys), dict(sums or {}), dict(lasts or {})
    values = {f"_v_{out}": value for out, value in {**sums, **lasts}.items()}
    rows = sliced(df.withColumns(values), keys, order)
    at = F.struct(*order)
    totals = rows.groupBy(*keys, "_slice").agg(
        *[F.sum(f"_v_{out}").alias(f"_t_{out}") for out in sums],
        *[F.max_by(f"_v_{out}", F.when(F.col(f"_v_{out}").isNotNull(), at)).alias(f"_t_{out}") for out in lasts],
    )
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_slice").alias("_k_slice"),
        *[F.sum(f"_t_{out}").over(earlier).alias(f"_b_{out}") for out in sums],
        *[F.last(f"_t_{out}", ignorenulls=True).over(earlier).alias(f"_b_{out}") for out in lasts],
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = rows.withColumns(
        {
            **{f"_i_{out}": F.sum(f"_v_{out}").over(inside) for out in sums},
            **{f"_i_{out}": F.last(f"_v_{out}", ignorenulls=True).over(inside) for out in lasts},
        }
    )
    same = F.col("_slice") == F.col("_k_slice")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    whole = {
        out: F.coalesce(F.col(f"_i_{out}") + F.col(f"_b_{out}"), f"_i_{out}", f"_b_{out}") for out in sums
    } | {out: F.coalesce(f"_i_{out}", f"_b_{out}") for out in lasts}
    return scanned.join(before, same).withColumns(whole).select(*df.columns, *whole)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str) -> DataFrame:
    """Add `out`: the sum of `value` over the rows of the group up to this one."""
    return running(df, keys, order, sums={out: value})


def running_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Add `out`: 1-based position of the row in its group; `order` must be unique in the group."""
    return running(df, keys, order, sums={out: F.lit(1).cast("bigint")})


def last_known(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str) -> DataFrame:
    """Add `out`: the latest non-null `value` at or before the row (as-of lookup on one timeline)."""
    return running(df, keys, order, lasts={out: value})


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median") -> DataFrame:
    """Median per group (mean of the two middle values when the count is even); null values do not count.

    Equal values collapse to one weighted row before anything is ordered, and the cumulative
    weights are built slice by slice, so no task holds a whole group.
    """
    keys = list(keys)
    counts = df.dropna(subset=[value]).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    cumulative = via_table(running(counts, keys, [value], sums={"_upto": F.col("_n")}), "cumulative")  # read twice
    sizes = cumulative.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.sum("_n").alias("_size"))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    low = F.floor((F.col("_size") + 1) / 2)
    high = F.floor((F.col("_size") + 2) / 2)

    def holding(rank):
        return F.max(F.when((F.col("_upto") >= rank) & (F.col("_upto") - F.col("_n") < rank), F.col(value)))

    return cumulative.join(sizes, same).groupBy(*keys).agg(((holding(low) + holding(high)) / 2).alias(out))
