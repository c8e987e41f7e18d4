"""Exact interpolated quantiles per group, without holding a group in one task.

Built-in ``percentile`` merges a value-to-count map per group into a single task, which grows with
the distinct values. Here values are counted first (map-side combined, keyed by the value), the
counts are summed into bins of fixed width, and only the bins holding a wanted rank are opened.
Prices have two decimals and at most eight digits before the point, so a group has at most 2e5 bins
of 1000 and a bin at most 1e5 distinct values: every sort below works on a bounded set.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfprice.functions.numeric import rint6

BIN_WIDTH = 1000.0


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys, value, bin, n``: how often each value occurs in each group; NULL keys form no group.

    The counts feed two branches of the quantile plan that join on the keys and the bin. Stating here
    that those are not NULL keeps the branches alike, so that Spark runs the scan and the shuffle
    below them once and reuses the exchange.
    """
    bin_ = F.floor(F.col(value) / BIN_WIDTH)
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.col(value).isNotNull())
    return (
        df.where(present & bin_.isNotNull())
        .groupBy(*keys, F.col(value).alias("value"), bin_.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _position(prob: float, total: Column, method: str) -> Column:
    """0-based fractional rank of a quantile."""
    if method == "linear":
        return F.lit(prob) * (total - 1)
    if method == "hazen":
        at = F.lit(prob) * total - F.lit(0.5)
        return F.least(F.greatest(at, F.lit(0.0)), (total - 1).cast("double"))
    raise ValueError(f"unknown quantile method {method!r}")


def quantiles_of_counts(
    counts: DataFrame, keys: list[str], probs: dict[str, float], method: str = "linear"
) -> DataFrame:
    """One row per group: ``keys`` plus one column per entry of ``probs`` (name to probability)."""
    along = Window.partitionBy(*keys).orderBy("bin")
    whole = Window.partitionBy(*keys)

    ranks = []
    for name, prob in probs.items():
        at = _position(prob, F.col("total"), method)
        low = F.floor(at)
        for side, rank in ((0, low), (1, F.ceil(at))):
            ranks.append(
                F.struct(
                    F.lit(name).alias("name"), F.lit(side).alias("side"), rank.alias("rank"), (at - low).alias("part")
                )
            )

    def inside(first: Column, n: Column):
        return lambda r: (r["rank"] >= first) & (r["rank"] < first + n)

    wanted = (
        counts.groupBy(*keys, "bin")
        .agg(F.sum("n").alias("bin_n"))
        .withColumn("before", F.sum("bin_n").over(along) - F.col("bin_n"))
        .withColumn("total", F.sum("bin_n").over(whole))
        .withColumn("ranks", F.filter(F.array(*ranks), inside(F.col("before"), F.col("bin_n"))))
        .where(F.size("ranks") > 0)
        .select(*keys, "bin", "before", "ranks")
    )
    in_bin = Window.partitionBy(*keys, "bin").orderBy("value")
    first = F.col("before") + F.sum("n").over(in_bin) - F.col("n")
    hits = (
        counts.join(wanted, [*keys, "bin"])
        .withColumn("first", first)
        .select(*keys, "value", F.explode(F.filter("ranks", inside(F.col("first"), F.col("n")))).alias("r"))
        .select(*keys, "value", "r.*")
    )
    results = []
    for name in probs:
        low = F.max(F.when((F.col("name") == name) & (F.col("side") == 0), F.col("value")))
        high = F.max(F.when((F.col("name") == name) & (F.col("side") == 1), F.col("value")))
        part = F.max(F.when(F.col("name") == name, F.col("part")))
        results.append(rint6(low + (high - low) * part).alias(name))
    if keys:
        return hits.groupBy(*keys).agg(*results)
    return hits.agg(*results)


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float], method: str = "linear"
) -> DataFrame:
    return quantiles_of_counts(value_counts(df, keys, value), keys, probs, method)
