"""Joins whose strategy follows a measured size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfprice.plans.staging import stage

# A table may be broadcast up to this many rows and bytes of text in them.
BROADCAST_ROWS = 100_000
BROADCAST_TEXT_BYTES = 32 * 1024 * 1024

# A group is hot when it holds at least this part of all rows, so at most 1000 groups can be.
HOT_PART = 1000

# Hot rows are spread over this many join keys.
SPREAD = 65_536


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_text_bytes: int = BROADCAST_TEXT_BYTES) -> bool:
    """Measure, in one pass over a table that is cheap to read, whether it may be broadcast."""
    sized = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    texts = [F.coalesce(F.octet_length(name), F.lit(0)) for name in sized]
    text_bytes = F.coalesce(F.sum(reduce(lambda a, b: a + b, texts, F.lit(0))), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), text_bytes).first()
    return rows <= max_rows and size <= max_text_bytes


def attach_groups(
    rows: DataFrame,
    groups: DataFrame,
    on: list[str],
    how: str = "left",
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join one-row-per-group values back to the rows of their groups (``how`` left or inner).

    ``groups`` is staged and measured first. A small one is broadcast, so the rows are not shuffled
    at all; otherwise the rows are shuffled with hot groups split.
    """
    groups = stage(groups, "groups")
    if is_small(groups, max_broadcast_rows):
        return rows.join(F.broadcast(groups), on, how)
    return _shuffled(rows, groups, on, how)


def _shuffled(rows: DataFrame, groups: DataFrame, on: list[str], how: str) -> DataFrame:
    """One shuffle of the rows, none of a hot group to one task.

    Hot groups, at most ``HOT_PART``, get their values by broadcast. Their rows, and rows without a
    full key, still pass the shuffle of the others, but under keys of their own that spread evenly
    and match nothing there.
    """
    values = [c for c in groups.columns if c not in on]
    sizes = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.sum("_n")).scalar()
    full_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
    hot_keys = stage(sizes.where((F.col("_n") * HOT_PART >= total) & full_key).select(*on), "hot_keys")
    hot_values = stage(groups.join(F.broadcast(hot_keys), on, "left_semi"), "hot_values")
    known = hot_values.withColumn("_known", F.lit(True))
    hot = hot_keys.join(F.broadcast(known), on, "left").select(*on, F.struct("_known", *values).alias("_hot"))

    # A hash of the whole row, not a random number: a retried task must place its rows alike.
    apart = F.pmod(F.xxhash64(*rows.columns), F.lit(SPREAD)) + 1
    # Always 0, but not a literal: Spark would fold that out of the join keys.
    at_home = F.pmod(F.xxhash64(*on), F.lit(1)).cast("long")
    is_cold = F.col("_hot").isNull() & full_key
    marked = rows.join(F.broadcast(hot), on, "left").withColumn("_place", F.when(is_cold, at_home).otherwise(apart))
    cold = groups.select(*on, at_home.alias("_place"), F.struct(F.lit(True).alias("_known"), *values).alias("_cold"))
    joined = marked.join(cold, [*on, "_place"], "left")
    found = F.coalesce("_hot", "_cold")
    if how == "inner":
        joined = joined.where(found["_known"])
    rest = [c for c in rows.columns if c not in on]
    return joined.select(*on, *rest, *[found[c].alias(c) for c in values])
