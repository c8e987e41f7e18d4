"""Statistics over the cleaned listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfprice.functions.buckets import PRICE_LABELS, bucket_label, bucket_ord
from shelfprice.functions.numeric import exact_mean, exact_sum, rint2, rint6
from shelfprice.functions.text import title_case
from shelfprice.plans.joins import attach_groups
from shelfprice.plans.topk import top
from shelfprice.schema import ORDER_KEY

TOP_N = 10
MIN_BRAND_LISTINGS = 3
DEEP_DISCOUNT = 50


def _n() -> Column:
    return F.count(F.lit(1))


def platform_profile(cleaned: DataFrame) -> DataFrame:
    """Every additive per-platform figure in one pass and one row per platform.

    The header, the overview, the deep-discount counts, the price ranges and the insights all roll
    up from these rows instead of scanning the listings again.
    """
    bucket = bucket_ord(F.col("current_price"))
    return cleaned.groupBy("platform").agg(
        _n().alias("n"),
        F.count("current_price").alias("n_price"),
        exact_sum(F.col("current_price")).alias("sum_price"),
        F.count("discount_pct").alias("n_discount"),
        exact_sum(F.col("discount_pct")).alias("sum_discount"),
        F.count_if(F.col("discount_pct") > DEEP_DISCOUNT).alias("n_deep"),
        *[F.count_if(bucket == i).alias(f"n_bucket_{i}") for i in range(len(PRICE_LABELS))],
    )


def dataset_header(cleaned: DataFrame) -> DataFrame:
    """One row: number of listings, number of platforms, sorted platform list (comma-joined)."""
    per_platform = cleaned.groupBy("platform").agg(_n().alias("n"))
    platforms = F.sort_array(F.collect_list("platform"))
    return per_platform.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("platform").alias("platform_count"),
        F.array_join(platforms, ", ").alias("platforms"),
    )


def overview_columns() -> dict[str, Column]:
    """The rounded means and share of a profile row."""
    return {
        "avg_current_price": rint2(F.try_divide("sum_price", "n_price")),
        "avg_discount_pct": rint2(F.try_divide("sum_discount", "n_discount")),
        "pct_products_with_discount": rint2(F.try_divide("n_discount", "n") * 100),
    }


def overview_of_profile(profile: DataFrame) -> DataFrame:
    rounded = [c.alias(name) for name, c in overview_columns().items()]
    return profile.select("platform", F.col("n").alias("total_products"), *rounded)


def platform_overview(cleaned: DataFrame) -> DataFrame:
    """Per platform: listings, mean price, mean discount, share with a stated discount (0 counts)."""
    return overview_of_profile(platform_profile(cleaned))


def discount_distribution(cleaned: DataFrame) -> DataFrame:
    """One row: min, max, mean, median of the stated discounts and how many exceed 50 %.

    Discounts are counted per value first. They have two decimals and three digits before the
    point, so the final row merges at most 2e5 counts, whatever the number of listings.
    """
    counts = (
        cleaned.where(F.col("discount_pct").isNotNull())
        .groupBy("discount_pct")
        .agg(_n().alias("n"))
    )
    d = F.col("discount_pct")
    return counts.agg(
        rint2(F.min(d)).alias("min"),
        rint2(F.max(d)).alias("max"),
        rint2(F.try_divide(exact_sum(d, F.col("n")), F.sum("n"))).alias("mean"),
        rint2(F.percentile(d, F.lit(0.5), F.col("n"))).alias("median"),
        F.coalesce(F.sum(F.when(d > DEEP_DISCOUNT, F.col("n"))), F.lit(0)).alias("count_above_50pct"),
    )


def top_discounted(cleaned: DataFrame, n: int = TOP_N) -> DataFrame:
    """Listings with the largest stated discount; ties go to the first by order key."""
    stated = cleaned.where(F.col("discount_pct").isNotNull())
    return top(stated, n, F.desc("discount_pct"), F.asc(ORDER_KEY)).select(
        "platform", "brand", "product_name", "current_price", "discount_pct"
    )


def over50_by_platform(cleaned: DataFrame) -> DataFrame:
    """Listings above 50 % per platform; platforms without any are absent."""
    return cleaned.where(F.col("discount_pct") > DEEP_DISCOUNT).groupBy("platform").agg(_n().alias("listings"))


def brand_profile(cleaned: DataFrame) -> DataFrame:
    """Counts and sums per brand, shared by the three brand rankings."""
    return (
        cleaned.where(F.col("brand").isNotNull())
        .groupBy("brand")
        .agg(
            _n().alias("n"),
            F.count("discount_pct").alias("n_discount"),
            exact_sum(F.col("discount_pct")).alias("sum_discount"),
            F.count("current_price").alias("n_price"),
            exact_sum(F.col("current_price")).alias("sum_price"),
        )
    )


def brands_by_count(profile: DataFrame, n: int = TOP_N) -> DataFrame:
    return top(profile, n, F.desc("n"), F.asc("brand")).select("brand", F.col("n").alias("product_count"))


def _brands_by_mean(profile: DataFrame, what: str, alias: str, n: int) -> DataFrame:
    # Sums are exact, so the quotient is the same whatever the partitioning, and ranks as it is.
    mean = F.col(f"sum_{what}") / F.col(f"n_{what}")
    ranked = profile.where(F.col(f"n_{what}") >= MIN_BRAND_LISTINGS).select(
        "brand", mean.alias("_mean"), F.col(f"n_{what}").alias("count")
    )
    return top(ranked, n, F.desc("_mean"), F.asc("brand")).select("brand", rint2(rint6(F.col("_mean"))).alias(alias), "count")


def brands_by_discount(profile: DataFrame, n: int = TOP_N) -> DataFrame:
    return _brands_by_mean(profile, "discount", "avg_discount", n)


def brands_by_price(profile: DataFrame, n: int = TOP_N) -> DataFrame:
    return _brands_by_mean(profile, "price", "avg_price", n)


def top_brands_count(cleaned: DataFrame, n: int = TOP_N) -> DataFrame:
    """Brands with most listings; ties by brand."""
    return brands_by_count(brand_profile(cleaned), n)


def top_brands_discount(cleaned: DataFrame, n: int = TOP_N) -> DataFrame:
    """Brands with the largest mean stated discount among those with at least three such listings."""
    return brands_by_discount(brand_profile(cleaned), n)


def top_brands_price(cleaned: DataFrame, n: int = TOP_N) -> DataFrame:
    """Brands with the largest mean price among those with at least three priced listings."""
    return brands_by_price(brand_profile(cleaned), n)


def with_price_bucket(cleaned: DataFrame) -> DataFrame:
    """Add ``bucket_ord`` (sortable) and ``price_bucket`` (label); both NULL out of range."""
    df = cleaned.withColumn("bucket_ord", bucket_ord(F.col("current_price")))
    return df.withColumn("price_bucket", bucket_label(F.col("bucket_ord")))


def bucket_counts(cleaned: DataFrame) -> DataFrame:
    """Listings per price range; empty ranges are absent."""
    counts = (
        cleaned.groupBy(bucket_ord(F.col("current_price")).alias("bucket_ord"))
        .agg(_n().alias("product_count"))
        .where(F.col("bucket_ord").isNotNull())
    )
    return counts.select("bucket_ord", bucket_label(F.col("bucket_ord")).alias("price_bucket"), "product_count")


def bucket_avg_price(cleaned: DataFrame) -> DataFrame:
    """Mean price per platform and price range; absent pairs are absent."""
    means = (
        cleaned.groupBy("platform", bucket_ord(F.col("current_price")).alias("bucket_ord"))
        .agg(rint2(exact_mean(F.col("current_price"))).alias("avg_price"))
        .where(F.col("bucket_ord").isNotNull())
    )
    return means.select("platform", "bucket_ord", bucket_label(F.col("bucket_ord")).alias("price_bucket"), "avg_price")


def price_extremes(cleaned: DataFrame) -> DataFrame:
    """Per platform the cheapest and the dearest listing; ties go to the first by order key.

    A first pass over two columns finds the extreme prices by hash aggregation. Only listings at
    those prices enter the second aggregation, which sorts because it compares whole rows.
    """
    price = F.col("current_price")
    priced = cleaned.where(price.isNotNull() & F.col("platform").isNotNull())
    bounds = priced.groupBy("platform").agg(F.min(price).alias("_low"), F.max(price).alias("_high"))
    at_bounds = attach_groups(priced, bounds, ["platform"], "inner").where(price.isin(F.col("_low"), F.col("_high")))
    listing = F.struct(F.col(ORDER_KEY).alias("key"), F.col("product_name"), F.col("brand"), price)
    picked = at_bounds.groupBy("platform").agg(
        F.min(F.when(price == F.col("_low"), listing)).alias("cheapest"),
        F.min(F.when(price == F.col("_high"), listing)).alias("dearest"),
    )
    return picked.select(
        "platform",
        F.col("cheapest.product_name").alias("cheapest_name"),
        F.col("cheapest.brand").alias("cheapest_brand"),
        F.col("cheapest.current_price").alias("cheapest_price"),
        F.col("dearest.product_name").alias("dearest_name"),
        F.col("dearest.brand").alias("dearest_brand"),
        F.col("dearest.current_price").alias("dearest_price"),
    )


def insights_of_profile(profile: DataFrame) -> DataFrame:
    """``insight_no, subject, value, share`` from the per-platform rows."""
    overview = profile.withColumns(overview_columns())

    def leader(measure: str) -> Column:
        return F.min(F.when(F.col(measure).isNotNull(), F.struct((-F.col(measure)).alias("by"), F.col("platform"))))

    ranges = range(len(PRICE_LABELS))
    one = overview.agg(
        leader("avg_discount_pct").alias("discounter"),
        leader("pct_products_with_discount").alias("promoter"),
        leader("avg_current_price").alias("premium"),
        F.sum("n").alias("n"),
        F.sum("n_deep").alias("n_deep"),
        *[F.sum(f"n_bucket_{i}").alias(f"n_bucket_{i}") for i in ranges],
    ).where(F.col("n") > 0)
    modal = F.array_min(
        F.array(*[F.struct((-F.col(f"n_bucket_{i}")).alias("by"), F.lit(i).alias("bucket_ord")) for i in ranges])
    )

    def share(n: Column) -> Column:
        return rint2(F.try_divide(n, F.col("n")) * 100)

    def row(no: int, subject: Column, value: Column, part: Column) -> Column:
        return F.struct(
            F.lit(no).alias("insight_no"),
            subject.cast("string").alias("subject"),
            value.cast("double").alias("value"),
            part.cast("double").alias("share"),
        )

    none = F.lit(None)
    rows = F.array(
        row(1, F.col("discounter.platform"), -F.col("discounter.by"), none),
        row(2, F.col("promoter.platform"), -F.col("promoter.by"), none),
        row(3, none, F.col("n_deep"), share(F.col("n_deep"))),
        row(4, bucket_label(F.col("modal.bucket_ord")), -F.col("modal.by"), share(-F.col("modal.by"))),
        row(5, F.col("premium.platform"), -F.col("premium.by"), none),
    )
    return one.withColumn("modal", modal).select(F.inline(rows)).where(F.col("value").isNotNull())


def key_insights(cleaned: DataFrame) -> DataFrame:
    """Five findings as numbers, from one pass over the listings.

    1 platform with the deepest mean discount, 2 platform with the largest discounted share, 3 listings
    above 50 % and their share of all listings, 4 fullest price range with count and share, 5 platform
    with the highest mean price. Ties go to the first platform or the lowest range. An empty table
    gives no rows.
    """
    return insights_of_profile(platform_profile(cleaned))


def insight_text(insights: DataFrame) -> DataFrame:
    """``insight_no, text``: one English sentence per finding."""
    number, subject = F.col("insight_no"), title_case(F.col("subject"))
    pct = F.format_string("%.1f%%", "value")
    share = F.format_string("%.1f%%", "share")
    count = F.format_string("%.0f", "value")
    mean_price = F.format_string("%.2f", "value")
    text = (
        F.when(number == 1, F.concat(subject, F.lit(" discounts deepest: "), pct, F.lit(" off on average.")))
        .when(number == 2, F.concat(subject, F.lit(" discounts most often: "), pct, F.lit(" of its listings.")))
        .when(number == 3, F.concat(count, F.lit(" listings ("), share, F.lit(") are more than 50% off.")))
        .when(
            number == 4,
            F.concat(F.lit("Most listings cost "), F.col("subject"), F.lit(": "), count, F.lit(" ("), share, F.lit(").")),
        )
        .otherwise(F.concat(subject, F.lit(" is the dearest platform: "), mean_price, F.lit(" on average.")))
    )
    return insights.select("insight_no", text.alias("text"))
