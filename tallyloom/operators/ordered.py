"""Ordered windows for keys that may hold a large share of all rows.

A plain window sorts every row of a key in one task. Here the key is split into segments that
follow the order (a day, a block of sequence numbers); rows are ordered inside a segment, and only
one summary row per segment is ordered across the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def block_of(seq: Column, rows: int) -> Column:
    """Segment number of a unique whole-number sequence."""
    return F.floor(seq / F.lit(rows))


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join that also pairs null keys; keeps the left copy of the keys."""
    renamed = right.select([F.col(c).alias(f"__{c}") if c in keys else F.col(c) for c in right.columns])
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__{k}"]) for k in keys])
    return left.join(renamed, on, how).drop(*[f"__{k}" for k in keys])


def row_number(df: DataFrame, keys: Sequence[str], segment: Column, order: Sequence[Column], out: str) -> DataFrame:
    """1-based position of each row within its key."""
    cut = df.withColumn("__seg", segment)
    group = [*keys, "__seg"]
    sizes = cut.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*group, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__skip"))
    local = cut.withColumn("__at", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return (
        join_same(local, offsets, group)
        .withColumn(out, (F.col("__at") + F.col("__skip")).cast("bigint"))
        .drop("__seg", "__at", "__skip")
    )


def previous(
    df: DataFrame, keys: Sequence[str], segment: Column, order: Sequence[Column], value: Column, out: str
) -> DataFrame:
    """Value of the row before, within the key; null for the first row of a key."""
    cut = df.withColumn("__seg", segment).withColumn("__val", value)
    group = [*keys, "__seg"]
    by_order = Window.partitionBy(*group).orderBy(*order)
    tails = cut.groupBy(*group).agg(F.max_by(F.struct("__val"), F.struct(*order)).alias("__tail"))
    carried = tails.select(
        *group, F.lag(F.col("__tail")["__val"]).over(Window.partitionBy(*keys).orderBy("__seg")).alias("__carry")
    )
    local = cut.withColumn("__at", F.row_number().over(by_order)).withColumn("__prev", F.lag("__val").over(by_order))
    return (
        join_same(local, carried, group)
        .withColumn(out, F.when(F.col("__at") == 1, F.col("__carry")).otherwise(F.col("__prev")))
        .drop("__seg", "__val", "__at", "__prev", "__carry")
    )


def running_total(
    df: DataFrame, keys: Sequence[str], segment: Column, order: Sequence[Column], value: Column, out: str
) -> DataFrame:
    """Sum of `value` over the key up to and including the row."""
    cut = df.withColumn("__seg", segment).withColumn("__val", value)
    group = [*keys, "__seg"]
    sums = cut.groupBy(*group).agg(F.sum("__val").alias("__sum"))
    before = Window.partitionBy(*keys).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*group, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__skip"))
    upto = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumn("__run", F.sum("__val").over(upto))
    return (
        join_same(local, offsets, group)
        .withColumn(out, (F.col("__run") + F.col("__skip")).cast("bigint"))
        .drop("__seg", "__val", "__run", "__skip")
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool = False) -> DataFrame:
    """One whole row per key, the first (or last) by `order`. Aggregates map-side, no window."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    best = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("__row"))
    return best.select(*keys, "__row.*").select(*df.columns)


def sequence(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """Unique, not negative, growing ids in the order of the sort keys.

    The rows are range-partitioned, so no task sorts everything. Write the result before using it
    twice: the ranges are sampled.
    """
    return (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(out, F.monotonically_increasing_id())
    )
