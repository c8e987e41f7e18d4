"""Top-k and first-row-per-group building blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows of an order: every task keeps k rows, no full sort (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def first_per_group(df: DataFrame, keys: list[Column], *order: Column) -> DataFrame:
    """First row of each group.

    The rank filter is pushed below the shuffle (WindowGroupLimit), so each map task sends at most
    one row per group, however many rows a hot group has.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")
