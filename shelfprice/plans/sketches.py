"""Approximate quantiles from KLL sketches, for those who ask for them; everything else in this library is exact.

A sketch is a few kilobytes per group whatever the group's size, sketches of parts merge into that of the whole, and the
rank of an answer is off by at most ``RANK_ERROR`` of the rows (with 99 % confidence, for ``K``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Size of a sketch, and the rank error that goes with it: about 2.3 / K ** 0.9.
K = 800
RANK_ERROR = 0.006


def sketches(df: DataFrame, keys: list[str], column: str, k: int = K) -> DataFrame:
    """``keys, n, sketch`` of the values that are not NULL."""
    values = df.where(F.col(column).isNotNull()).select(*keys, F.col(column).cast("double").alias("_value"))
    return values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("_value", F.lit(k)).alias("sketch"))


def merged(parts: DataFrame, keys: list[str], k: int = K) -> DataFrame:
    """The sketch of each group from those of its parts."""
    return parts.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def quantiles_of_sketches(whole: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """One row per group: ``keys`` plus one value per entry of ``probs`` (name to probability)."""
    return whole.select(*keys, *[F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(name) for name, p in probs.items()])


def approx_quantiles(df: DataFrame, keys: list[str], column: str, probs: dict[str, float], k: int = K) -> DataFrame:
    """Quantiles of one pass over the rows with a small state per task; see ``RANK_ERROR``."""
    return quantiles_of_sketches(sketches(df, keys, column, k), keys, probs)
