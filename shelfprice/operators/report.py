"""The full report: every statistic of the cleaned table in one nested row."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfprice.functions.buckets import PRICE_LABELS
from shelfprice.operators import stats
from shelfprice.plans.staging import stage
from shelfprice.plans.topk import top
from shelfprice.schema import ORDER_KEY

_BRANDS = "array<struct<brand:string,{}:double,count:bigint>>"
_LISTING = "struct<product_name:string,brand:string,current_price:double>"

# Names and nesting of the report document.
REPORT_TYPES = {
    "generated_at": "string",
    "total_rows": "bigint",
    "platform_overview": "map<string,struct<total_products:bigint,avg_current_price:double,"
    "avg_discount_pct:double,pct_products_with_discount:double>>",
    "discount_behaviour": "struct<distribution:struct<min:double,max:double,mean:double,median:double,"
    "count_above_50pct:bigint>,top10_most_discounted:array<struct<platform:string,brand:string,"
    "product_name:string,current_price:double,discount_pct:double>>,over_50pct_per_platform:map<string,bigint>>",
    "brand_analysis": "struct<top10_by_product_count:array<struct<brand:string,product_count:bigint>>,"
    f"top10_by_avg_discount:{_BRANDS.format('avg_discount')},top10_by_avg_price:{_BRANDS.format('avg_price')}>",
    "price_analysis": "struct<bucket_counts:array<struct<price_bucket:string,product_count:bigint>>,"
    "avg_price_per_platform_per_bucket:array<struct<platform:string,price_bucket:string,avg_price:double>>,"
    f"extremes_per_platform:map<string,struct<cheapest:{_LISTING},most_expensive:{_LISTING}>>>",
    "key_insights": "array<string>",
}


def report_schema() -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"{name} {type_}" for name, type_ in REPORT_TYPES.items()))


def _rows(df: DataFrame, order: list[Column], *columns: str) -> DataFrame:
    """A handful of rows as one array, sorted."""
    entry = F.struct(F.struct(*order).alias("at"), F.struct(*columns).alias("row"))
    return df.agg(F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["row"]).alias("rows"))


def _map(key: str, value: Column) -> Column:
    return F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(key).alias("key"), value.alias("value")))))


def _profile_part(profile: DataFrame) -> DataFrame:
    overview = F.struct(
        F.col("n").alias("total_products"),
        *[c.alias(name) for name, c in stats.overview_columns().items()],
    )
    buckets = [
        F.struct(F.lit(name).alias("price_bucket"), F.sum(f"n_bucket_{i}").alias("product_count"))
        for i, name in enumerate(PRICE_LABELS)
    ]
    return profile.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        _map("platform", overview).alias("platform_overview"),
        F.map_filter(_map("platform", F.col("n_deep")), lambda _, n: n > 0).alias("over_50pct_per_platform"),
        F.filter(F.array(*buckets), lambda b: b["product_count"] > 0).alias("bucket_counts"),
    )


def report(cleaned: DataFrame, generated_at: str | None = None) -> DataFrame:
    """One row of :data:`REPORT_TYPES`.

    Per-platform and per-brand figures are aggregated and staged once; the parts are one row each,
    stacked and folded into one.
    """
    profile = stage(stats.platform_profile(cleaned), "profile")
    brands = stage(stats.brand_profile(cleaned), "brands")
    discounted = top(
        cleaned.where(F.col("discount_pct").isNotNull()), stats.TOP_N, F.desc("discount_pct"), F.asc(ORDER_KEY)
    )
    brand_parts = {
        "top10_by_product_count": (stats.brands_by_count(brands), "product_count", []),
        "top10_by_avg_discount": (stats.brands_by_discount(brands), "avg_discount", ["count"]),
        "top10_by_avg_price": (stats.brands_by_price(brands), "avg_price", ["count"]),
    }
    extremes = F.struct(
        *[
            F.struct(
                F.col(f"{side}_name").alias("product_name"),
                F.col(f"{side}_brand").alias("brand"),
                F.col(f"{side}_price").alias("current_price"),
            ).alias(name)
            for side, name in (("cheapest", "cheapest"), ("dearest", "most_expensive"))
        ]
    )
    distribution = stats.discount_distribution(cleaned)
    parts = [
        _profile_part(profile),
        distribution.select(F.struct(*distribution.columns).alias("distribution")),
        _rows(
            discounted,
            [-F.col("discount_pct"), F.col(ORDER_KEY)],
            "platform",
            "brand",
            "product_name",
            "current_price",
            "discount_pct",
        ).withColumnRenamed("rows", "top10_most_discounted"),
        *[
            _rows(df, [-F.col(by), F.col("brand")], "brand", by, *more).withColumnRenamed("rows", name)
            for name, (df, by, more) in brand_parts.items()
        ],
        _rows(
            stats.bucket_avg_price(cleaned),
            [F.col("platform"), F.col("bucket_ord")],
            "platform",
            "price_bucket",
            "avg_price",
        ).withColumnRenamed("rows", "avg_price_per_platform_per_bucket"),
        stats.price_extremes(cleaned).agg(_map("platform", extremes).alias("extremes_per_platform")),
        _rows(stats.insight_text(stats.insights_of_profile(profile)), [F.col("insight_no")], "text").select(
            F.transform("rows", lambda r: r["text"]).alias("key_insights")
        ),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    one = stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])
    stamp = generated_at or datetime.datetime.now().isoformat(timespec="seconds")
    built = {
        "generated_at": F.lit(stamp),
        "discount_behaviour": F.struct("distribution", "top10_most_discounted", "over_50pct_per_platform"),
        "brand_analysis": F.struct(*brand_parts),
        "price_analysis": F.struct("bucket_counts", "avg_price_per_platform_per_bucket", "extremes_per_platform"),
    }
    return one.select(*[built.get(name, F.col(name)).cast(type_).alias(name) for name, type_ in REPORT_TYPES.items()])


def report_json(cleaned: DataFrame, generated_at: str | None = None) -> DataFrame:
    """One row, one column: the report as indented JSON with explicit nulls."""
    one = report(cleaned, generated_at)
    options = {"ignoreNullFields": "false", "pretty": "true"}
    return one.select(F.to_json(F.struct(*one.columns), options).alias("report"))


def kpi_of_report(saved: DataFrame) -> DataFrame:
    """The three platform measures in long form from a saved report; no report, no rows."""
    measures = ["avg_current_price", "avg_discount_pct", "pct_products_with_discount"]
    per_platform = saved.select(F.explode("platform_overview").alias("platform", "o"))
    wide = per_platform.select("platform", *[F.coalesce(f"o.{m}", F.lit(0.0)).alias(m) for m in measures])
    return wide.unpivot(["platform"], measures, "metric", "value")
