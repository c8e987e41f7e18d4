"""The browsing view: options, filter, figures, search."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfprice.functions.numeric import exact_mean, rint2
from shelfprice.operators.charts import brand_bubble, bucket_share, discount_histogram, price_box_stats
from shelfprice.operators.stats import top_brands_count
from shelfprice.schema import DISPLAY_COLUMNS
from shelfprice.sources.clustered import Wanted
from shelfprice.sources.tables import read_listings

OPTION_BRANDS = 20
DEFAULT_MAX_PRICE = 1000.0


@dataclass(frozen=True)
class ListingFilter:
    """Choices of the view. The defaults keep every listing with a price of at least 0."""

    platforms: list[str] | None = None
    price_min: float = 0.0
    price_max: float | None = None
    brands: list[str] = field(default_factory=list)
    min_discount: float = 0


def filter_options(listings: DataFrame) -> DataFrame:
    """What the unfiltered table offers: sorted platforms, price ceiling, top-20 brands (long form)."""
    per_platform = listings.groupBy("platform").agg(F.max("current_price").alias("top_price"))
    one = per_platform.agg(
        F.sort_array(F.collect_list("platform")).alias("platforms"), F.max("top_price").alias("top_price")
    )
    ceiling = F.when(F.col("top_price") != 0, F.col("top_price"))
    ceiling = F.coalesce(ceiling, F.lit(DEFAULT_MAX_PRICE))

    def option(kind: str, place: Column, label: Column, number: Column) -> list[Column]:
        return [
            F.lit(kind).alias("option"),
            place.cast("int").alias("place"),
            label.cast("string").alias("label"),
            number.cast("double").alias("number"),
        ]

    none = F.lit(None)
    from_platforms = one.select(
        F.inline(
            F.concat(
                F.transform("platforms", lambda p, i: F.struct(*option("platform", i + 1, p, none))),
                F.array(F.struct(*option("max_price", F.lit(1), none, ceiling))),
            )
        )
    )
    brands = top_brands_count(listings, OPTION_BRANDS).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("product_count")).alias("by"), "brand"))).alias("brands")
    )
    from_brands = brands.select(
        F.inline(F.transform("brands", lambda b, i: F.struct(*option("brand", i + 1, b["brand"], -b["by"]))))
    )
    return from_platforms.unionByName(from_brands)


def filter_listings(listings: DataFrame, choice: ListingFilter = ListingFilter()) -> DataFrame:
    """Listings matching every choice. A listing without a price never matches.

    All conditions are plain comparisons, so they reach the Parquet scan.
    """
    price = F.col("current_price")
    kept = price.isNotNull() & (price >= choice.price_min)
    if choice.price_max is not None:
        kept &= price <= choice.price_max
    if choice.platforms is not None:
        kept &= F.col("platform").isin(choice.platforms)
    if choice.brands:
        kept &= F.col("brand").isin(choice.brands)
    if choice.min_discount > 0:
        kept &= F.col("discount_pct") >= choice.min_discount
    return listings.where(kept)


def filter_table(spark: SparkSession, path: str, choice: ListingFilter = ListingFilter()) -> DataFrame:
    """:func:`filter_listings` over a stored table; of a clustered one only files with such prices, brands and discounts are opened."""
    wanted: Wanted = {"current_price": (choice.price_min, choice.price_max)}
    if choice.brands:
        wanted["brand"] = list(choice.brands)
    if choice.min_discount > 0:
        wanted["discount_pct"] = (choice.min_discount, None)
    return filter_listings(read_listings(spark, path, wanted), choice)


def kpi_row(view: DataFrame) -> DataFrame:
    """One row: listings, mean price, mean discount, percent with a stated discount."""
    n = F.count(F.lit(1))
    return view.agg(
        n.alias("total_products"),
        rint2(exact_mean(F.col("current_price"))).alias("avg_price"),
        rint2(exact_mean(F.col("discount_pct"))).alias("avg_discount"),
        rint2(F.try_divide(F.count("discount_pct"), n) * 100).alias("pct_discounted"),
    )


def avg_discount_by_platform(view: DataFrame) -> DataFrame:
    """Mean stated discount per platform, deepest first."""
    return (
        view.where(F.col("discount_pct").isNotNull())
        .groupBy("platform")
        .agg(rint2(exact_mean(F.col("discount_pct"))).alias("avg_discount"))
        .orderBy(F.desc("avg_discount"), "platform")
    )


def filtered_top_brands(listings: DataFrame, choice: ListingFilter) -> DataFrame:
    return top_brands_count(filter_listings(listings, choice))


def filtered_bubble(listings: DataFrame, choice: ListingFilter) -> DataFrame:
    return brand_bubble(filter_listings(listings, choice))


def filtered_buckets(listings: DataFrame, choice: ListingFilter) -> DataFrame:
    return bucket_share(filter_listings(listings, choice))


def filtered_histogram(listings: DataFrame, choice: ListingFilter) -> DataFrame:
    return discount_histogram(filter_listings(listings, choice))


def filtered_box(listings: DataFrame, choice: ListingFilter, method: str = "linear") -> DataFrame:
    return price_box_stats(filter_listings(listings, choice), method)


def _compile(pattern: str) -> None:
    """Let the engine that will run the pattern read it first."""
    try:
        SparkSession.active()._jvm.java.util.regex.Pattern.compile(pattern)
    except IllegalArgumentException as error:
        raise ValueError(f"not a pattern: {pattern!r}: {error}") from None


def _matches(term: str, regex: bool) -> Column:
    wanted = term.strip().lower()
    if not wanted:
        return F.lit(True)
    if regex:
        _compile(wanted)
        hits = [F.lower(c).rlike(wanted) for c in ("product_name", "brand")]
    else:
        hits = [F.lower(c).contains(F.lit(wanted)) for c in ("product_name", "brand")]
    return F.coalesce(hits[0], F.lit(False)) | F.coalesce(hits[1], F.lit(False))


def search_listings(view: DataFrame, term: str, regex: bool = False) -> DataFrame:
    """Listings whose name or brand contains the term, any case; a blank term keeps all.

    The term is literal unless ``regex`` is set; a malformed expression fails before any job runs.
    """
    return view.where(_matches(term, regex))


def search_counts(view: DataFrame, term: str, regex: bool = False) -> DataFrame:
    """One row: listings shown and listings in the view, in one pass."""
    return view.agg(F.count_if(_matches(term, regex)).alias("shown"), F.count(F.lit(1)).alias("total"))


def display_columns(view: DataFrame) -> DataFrame:
    """The browsing columns that exist, in display order."""
    return view.select(*[c for c in DISPLAY_COLUMNS if c in view.columns])
