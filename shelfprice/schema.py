"""Column lists and types of the listing tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Column order of the raw CSV drops and of the load.
RAW_COLUMNS = [
    "platform",
    "product_name",
    "brand",
    "current_price",
    "original_price",
    "discount_pct",
    "rating",
    "review_count",
    "product_url",
    "scraped_at",
    "category",
]

FLOAT_COLUMNS = ["current_price", "original_price", "discount_pct", "rating"]
INT_COLUMNS = ["review_count"]

# Total, first-seen-first order of the listings, unique per row. Any orderable type works (a BIGINT serial, or a
# struct such as (file path, row in file)); ties in every operator are broken by it.
ORDER_KEY = "order_key"

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

# SQL types of the base table. VARCHAR lengths are checked by the contract.
BASE_TYPES = {
    "platform": "string",
    "product_name": "string",
    "brand": "string",
    "current_price": "decimal(10,2)",
    "original_price": "decimal(10,2)",
    "discount_pct": "decimal(5,2)",
    "rating": "decimal(3,2)",
    "review_count": "int",
    "product_url": "string",
    "scraped_at": "timestamp_ntz",
    "category": "string",
}
NOT_NULL_COLUMNS = ["platform", "product_name"]
MAX_LENGTHS = {"platform": 50, "brand": 255, "category": 100}

CLEANED_TYPES = {
    **BASE_TYPES,
    "current_price": "double",
    "original_price": "double",
    "discount_pct": "double",
    "rating": "double",
}

# Columns of the browsing table, in display order.
DISPLAY_COLUMNS = [
    "platform",
    "brand",
    "product_name",
    "current_price",
    "original_price",
    "discount_pct",
    "rating",
    "review_count",
    "category",
    "scraped_at",
]

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("layout", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("captured_at", T.TimestampNTZType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)
