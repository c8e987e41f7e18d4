"""Listings, pages and CSV drops derived from the star schema (rules in FIXTURES.md)."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfprice.functions.numeric import rint2
from shelfprice.functions.text import iso_seconds
from shelfprice.operators.clean import clean
from shelfprice.operators.load import first_wins
from shelfprice.plans.staging import new_path, stage
from shelfprice.schema import ORDER_KEY, RAW_COLUMNS

KEY_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def sold_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the star schema that listings are made of; a good deal narrower than the listings."""
    joined = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    texts = ["r_name", "p_name", "p_brand", "p_type"]
    return joined.select(*KEY_COLUMNS, "l_quantity", "l_tax", "l_discount", "l_shipdate", "l_linestatus", *texts)


def raw_listings(spark: SparkSession, sf_dir: str, missing_urls: bool = False) -> DataFrame:
    """The listing fixture: typed listing columns, ``scraped_at`` as text, composite order key."""
    return _listings_of(sold_parts(spark, sf_dir), missing_urls)


def _captured_at() -> Column:
    return F.when(_every("l_orderkey", 53), F.lit("not a date")).otherwise(iso_seconds(F.col("l_shipdate")))


def _listings_of(sold: DataFrame, missing_urls: bool) -> DataFrame:
    unit = F.col("l_extendedprice") / F.col("l_quantity") / 20
    url = F.concat(F.lit("https://shop.example/"), F.col("l_partkey"), F.lit("-"), F.col("l_suppkey"))
    return sold.select(
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit(" "), "r_name", F.lit(" ")))
        .otherwise(F.lower("r_name"))
        .alias("platform"),
        F.when(_every("l_partkey", 97), F.col("l_partkey").cast("string"))
        .when(_every("l_partkey", 89), F.lit("x"))
        .otherwise(F.col("p_name"))
        .alias("product_name"),
        F.when(~_every("l_partkey", 10), F.col("p_brand")).alias("brand"),
        F.when(~(_every("l_suppkey", 25) & (F.col("l_linenumber") == 1)), rint2(unit)).alias("current_price"),
        F.when(~_every("l_linenumber", 2), rint2(unit * (1 + F.col("l_tax") * 5))).alias("original_price"),
        F.when(~_every("l_linenumber", 3), rint2(F.col("l_discount") * 800)).alias("discount_pct"),
        F.when(F.col("l_linenumber") != 7, 1 + F.col("l_tax") * 50).alias("rating"),
        F.when(F.col("l_quantity") <= 45, F.col("l_quantity").cast("int")).alias("review_count"),
        (F.when(~_every("l_orderkey", 101), url) if missing_urls else url).alias("product_url"),
        _captured_at().alias("scraped_at"),
        F.col("p_type").alias("category"),
        F.struct(*KEY_COLUMNS).alias(ORDER_KEY),
    )


def event_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second fixture: events as listings. No price reaches the last range."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("platform"),
        F.concat(F.lit("event "), F.col("event_id")).alias("product_name"),
        F.get_json_object("props", "$.k").alias("brand"),
        F.col("value").alias("current_price"),
        F.lit(None).cast("double").alias("original_price"),
        F.lit(None).cast("double").alias("discount_pct"),
        F.lit(None).cast("double").alias("rating"),
        F.lit(None).cast("int").alias("review_count"),
        F.lit(None).cast("string").alias("product_url"),
        F.col("ts").alias("scraped_at"),
        F.lit(None).cast("string").alias("category"),
        F.col("event_id").alias(ORDER_KEY),
    )


_written: dict[tuple[str, str, str], str] = {}
_lock = threading.RLock()


def written_once(spark: SparkSession, sf_dir: str, name: str, build, partition_by: list[str]) -> DataFrame:
    """A table of the load -> clean -> analyse chain, written once per application and read back."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with _lock:
        if key not in _written:
            path = new_path(spark, name)
            build().write.partitionBy(*partition_by).parquet(path)
            _written[key] = path
    return spark.read.parquet(_written[key])


def base_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base table: the fixture after first-wins."""
    return written_once(spark, sf_dir, "listings", lambda: first_wins(raw_listings(spark, sf_dir)), [])


def cleaned_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned table, partitioned by platform."""
    df = written_once(
        spark, sf_dir, "listings_cleaned", lambda: clean(base_listings(spark, sf_dir)), ["platform"]
    )
    return df.select(*RAW_COLUMNS, ORDER_KEY)


def text_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture as a capture run writes it: every cell text, NULL as ''."""
    return _texts_of(sold_parts(spark, sf_dir))


def sold_by_run(spark: SparkSession, sf_dir: str, run_no: Callable[[Column], Column]) -> DataFrame:
    """The columns that listings are made of, staged by capture run, so that a run does not read the others."""
    return stage(sold_parts(spark, sf_dir).withColumn("_run", run_no(_captured_at())), "sold_parts", ["_run"])


def sorted_run(sold: DataFrame, run: int) -> DataFrame:
    """Text listings of one capture run of :func:`sold_by_run` in the order of their key; what is sorted are the narrow rows."""
    return _texts_of(sold.where(F.col("_run") == run).drop("_run").orderBy(*KEY_COLUMNS))


def _texts_of(sold: DataFrame) -> DataFrame:
    def as_text(name: str) -> Column:
        if name in ("current_price", "original_price", "discount_pct", "rating"):
            return F.col(name).cast("decimal(12,2)").cast("string")
        return F.col(name).cast("string")

    df = _listings_of(sold, missing_urls=True)
    return df.select(*[F.coalesce(as_text(c), F.lit("")).alias(c) for c in RAW_COLUMNS], ORDER_KEY)
