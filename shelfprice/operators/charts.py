"""Datasets behind the charts (drawing is left to any plotting tool)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfprice.functions.buckets import PRICE_LABELS, bucket_ord, discount_bin
from shelfprice.functions.numeric import exact_mean, rint2, rint6
from shelfprice.operators.stats import MIN_BRAND_LISTINGS, TOP_N, platform_overview
from shelfprice.plans.joins import attach_groups
from shelfprice.plans.quantiles import exact_quantiles, quantiles_of_counts, value_counts
from shelfprice.plans.staging import stage
from shelfprice.plans.topk import top

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
FENCE = 1.5
MAX_MARKER = 40


def _with_fences(quartiles: DataFrame) -> DataFrame:
    reach = (F.col("q3") - F.col("q1")) * FENCE
    return quartiles.withColumn("low_fence", rint6(F.col("q1") - reach)).withColumn(
        "high_fence", rint6(F.col("q3") + reach)
    )


def price_box_stats(listings: DataFrame, method: str = "linear") -> DataFrame:
    """Per platform: quartiles, whiskers (furthest prices within 1.5 IQR) and number of outliers.

    The listings are read once, into counts per distinct price; everything else works on those.
    """
    counts = stage(value_counts(listings, ["platform"], "current_price"), "price_counts")
    fences = _with_fences(quantiles_of_counts(counts, ["platform"], QUARTILES, method))
    inside = F.col("value").between(F.col("low_fence"), F.col("high_fence"))
    return (
        attach_groups(counts, fences, ["platform"], "inner")
        .groupBy("platform", *QUARTILES)
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("low_whisker"),
            F.max(F.when(inside, F.col("value"))).alias("high_whisker"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
            F.sum("n").alias("priced"),
        )
    )


def price_outliers(listings: DataFrame, method: str = "linear") -> DataFrame:
    """Listings priced beyond the fences of their platform."""
    fences = _with_fences(exact_quantiles(listings, ["platform"], "current_price", QUARTILES, method))
    joined = attach_groups(listings, fences.select("platform", "low_fence", "high_fence"), ["platform"], "inner")
    price = F.col("current_price")
    return joined.where((price < F.col("low_fence")) | (price > F.col("high_fence"))).select(*listings.columns)


def discount_histogram(listings: DataFrame) -> DataFrame:
    """Stated discounts per platform in bins of 5 points over [0, 100); the rest under a NULL bin."""
    return (
        listings.where(F.col("discount_pct").isNotNull())
        .groupBy("platform", discount_bin(F.col("discount_pct")).alias("bin_start"))
        .agg(F.count(F.lit(1)).alias("listings"))
    )


def brand_platform_matrix(listings: DataFrame, n: int = TOP_N) -> DataFrame:
    """Listings of the top brands per platform, long form, 0 where a brand is not on a platform.

    One pass counts brand and platform together; totals, ranking and zero filling use those counts.
    """
    pairs = (
        listings.where(F.col("brand").isNotNull())
        .groupBy("brand", "platform")
        .agg(F.count(F.lit(1)).alias("listings"))
    )
    ranked = top(pairs.groupBy("brand").agg(F.sum("listings").alias("total")), n, F.desc("total"), F.asc("brand"))
    # At most n brands meet on one platform, and n rows are broadcast.
    per_platform = (
        pairs.join(F.broadcast(ranked.select("brand")), "brand", "left_semi")
        .groupBy("platform")
        .agg(F.map_from_entries(F.collect_list(F.struct("brand", "listings"))).alias("found"))
    )
    brands = ranked.agg(F.collect_list(F.struct("brand", "total"))).scalar()
    return (
        per_platform.withColumn("b", F.explode(brands))
        .select(
            F.col("b.brand").alias("brand"),
            "platform",
            F.coalesce(F.try_element_at("found", F.col("b.brand")), F.lit(0)).alias("listings"),
            F.col("b.total").alias("brand_total"),
        )
    )


def brand_platform_pivot(listings: DataFrame, platforms: list[str], n: int = TOP_N) -> DataFrame:
    """The matrix in wide form, one column per platform of a known list."""
    return brand_platform_matrix(listings, n).groupBy("brand").pivot("platform", platforms).sum("listings").fillna(0)


def brand_bubble(listings: DataFrame) -> DataFrame:
    """Mean price, mean discount and count per brand (three or more complete listings), plus marker scale."""
    complete = F.col("brand").isNotNull() & F.col("current_price").isNotNull() & F.col("discount_pct").isNotNull()
    brands = (
        listings.where(complete)
        .groupBy("brand")
        .agg(
            rint2(exact_mean(F.col("current_price"))).alias("avg_price"),
            rint2(exact_mean(F.col("discount_pct"))).alias("avg_discount"),
            F.count(F.lit(1)).alias("product_count"),
        )
        .where(F.col("product_count") >= MIN_BRAND_LISTINGS)
    )
    # The maximum is taken over whole rows, so that this branch needs the same aggregate as the rows
    # themselves and Spark reuses its exchange instead of scanning the listings again.
    largest = brands.agg(F.max(F.struct("product_count", "brand", "avg_price", "avg_discount"))).scalar()
    return brands.withColumn("size_ref", largest["product_count"] * 2.0 / (MAX_MARKER * MAX_MARKER))


def bucket_share(listings: DataFrame) -> DataFrame:
    """Listings per price range with percent of the ranged listings, and the number of priced listings."""
    bucket = bucket_ord(F.col("current_price"))
    ranges = range(len(PRICE_LABELS))
    one = listings.agg(
        F.count("current_price").alias("priced_total"),
        *[F.count_if(bucket == i).alias(f"n_{i}") for i in ranges],
    )
    rows = [
        F.struct(
            F.lit(i).alias("bucket_ord"),
            F.lit(PRICE_LABELS[i]).alias("price_bucket"),
            F.col(f"n_{i}").alias("product_count"),
        )
        for i in ranges
    ]
    ranged = sum((F.col(f"n_{i}") for i in ranges), F.lit(0))
    return (
        one.withColumn("ranged", ranged)
        .select(F.inline(F.array(*rows)), "ranged", "priced_total")
        .where(F.col("product_count") > 0)
        .select(
            "bucket_ord",
            "price_bucket",
            "product_count",
            rint2(F.col("product_count") / F.col("ranged") * 100).alias("pct"),
            "priced_total",
        )
    )


def platform_kpi_long(listings: DataFrame) -> DataFrame:
    """Three measures per platform in long form, missing means as 0."""
    measures = ["avg_current_price", "avg_discount_pct", "pct_products_with_discount"]
    overview = platform_overview(listings).select("platform", *[F.coalesce(m, F.lit(0.0)).alias(m) for m in measures])
    return overview.unpivot(["platform"], measures, "metric", "value")
