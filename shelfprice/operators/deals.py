"""Is a listing cheaper than its platform usually is in that category?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfprice.functions.numeric import exact_mean, rint2, rint6
from shelfprice.plans.joins import attach_groups


def genuine_deals(listings: DataFrame) -> DataFrame:
    """Priced listings with the mean price of their platform and category and an ``is_deal`` flag."""
    priced = listings.where(F.col("current_price").isNotNull())
    keys = ["platform", "category"]
    named = priced.where(F.col("platform").isNotNull() & F.col("category").isNotNull())
    means = named.groupBy(*keys).agg(rint6(exact_mean(F.col("current_price"))).alias("_mean"))
    return (
        attach_groups(named, means, keys)
        .withColumn("category_mean", rint2(F.col("_mean")))
        .withColumn("is_deal", F.col("current_price") < F.col("_mean"))
        .drop("_mean")
    )
