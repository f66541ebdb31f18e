"""Operators on ordered rows: sections, numbering, as-of and positional lookups, gap groups. All take keys and an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _before(keys: list[str], order: list, upto: int = 0):  # noqa: ANN202
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, upto)


def carry_section(df: DataFrame, keys: list[str], order: list, heading: Column, label: Column, default: str = "") -> DataFrame:
    """Column section: the label of the nearest heading at or before the row."""
    return df.withColumn("section", F.coalesce(F.last(F.when(heading, label), ignorenulls=True).over(_before(keys, order)), F.lit(default)))


def nth_section(df: DataFrame, keys: list[str], order: list, heading: Column, n: int) -> DataFrame:
    """The rows from the n-th heading on, before the next."""
    return df.withColumn("heading_no", F.sum(heading.cast("int")).over(_before(keys, order))).where(F.col("heading_no") == n)


def autonumber(df: DataFrame, keys: list[str], order: list, start: int | Column = 1) -> DataFrame:
    return df.withColumn("number", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1 + start)


def asof_before(left: DataFrame, right: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """left with the value of right's last row that lies strictly before it; null if there is none. One union and one window."""
    columns = left.columns
    both = left.withColumn("_v", F.lit(None).cast(right.schema[value].dataType)).withColumn("_r", F.lit(0)).unionByName(
        right.select(*keys, at, F.col(value).alias("_v"), F.lit(1).alias("_r")), allowMissingColumns=True
    )
    frame = Window.partitionBy(*keys).orderBy(at, "_r").rowsBetween(Window.unboundedPreceding, -1)
    # Rows of left sort first among equals, so what stands before them is strictly earlier.
    return both.withColumn(value, F.last("_v", ignorenulls=True).over(frame)).where("_r = 0").select(*columns, value)


def next_with_barrier(df: DataFrame, keys: list[str], order: list, source: Column, target: Column, barrier: Column, value: str, name: str) -> DataFrame:
    """Source rows with the value of the next target row, unless a barrier row stands before it."""
    after = Window.partitionBy(*keys).orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    first = F.first(F.when(target | barrier, F.struct(target.alias("hit"), F.col(value).alias("v"))), ignorenulls=True).over(after)
    return df.withColumn("_n", first).withColumn(name, F.when(F.col("_n.hit"), F.col("_n.v"))).where(source).drop("_n")


def positional_zip(left: DataFrame, right: DataFrame, keys: list[str], left_order: list, right_order: list) -> DataFrame:
    """The i-th row of left beside the i-th of right, by key; column pos from 1."""
    number = lambda df, order: df.withColumn("pos", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return number(left, left_order).join(number(right, right_order), [*keys, "pos"])


def gap_groups(df: DataFrame, keys: list[str], at: str, gap: int) -> DataFrame:
    """Column gap_group: counts up where the step from the row before exceeds gap; column group_size."""
    ordered = Window.partitionBy(*keys).orderBy(at)
    new = F.coalesce((F.col(at) - F.lag(at).over(ordered) > gap).cast("int"), F.lit(0))
    return df.withColumn("_new", new).withColumn("gap_group", F.sum("_new").over(_before(keys, [at]))).drop("_new").withColumn("group_size", F.count(F.lit(1)).over(Window.partitionBy(*keys, "gap_group")))


def first_of(df: DataFrame, keys: list, order: list) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def best_group(df: DataFrame, keys: list[str], score: Column, least: int = 2) -> DataFrame:
    """Of the gap groups with `least` rows or more, the one of the highest score, the first of equals; all rows if there is none."""
    scored = df.withColumn("_s", F.sum(score).over(Window.partitionBy(*keys, "gap_group"))).withColumn("_ok", F.col("group_size") >= least)
    whole = Window.partitionBy(*keys)
    best = F.max(F.when(F.col("_ok"), F.struct("_s", (-F.col("gap_group")).alias("g")))).over(whole)
    return scored.withColumn("_b", best).where(F.col("_b").isNull() | (F.col("_ok") & (F.col("gap_group") == -F.col("_b.g")))).drop("_s", "_ok", "_b")


def distinct_in_order(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """One row for each key and value, with the least order."""
    return df.groupBy(*keys, value).agg(F.min(order).alias(order))


def keep_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(order).alias(order))
