import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


LISTING_DDL = (
    "platform string, product_name string, brand string, current_price double, original_price double, "
    "discount_pct double, rating double, review_count int, product_url string, scraped_at string, category string, "
    "order_key bigint"
)


@pytest.fixture(scope="session")
def listings(spark):
    """Factory of listing frames from partial rows; the order key is the row number."""
    from shelfprice.schema import RAW_COLUMNS

    def make(*rows):
        full = [tuple(r.get(c) for c in RAW_COLUMNS) + (r.get("order_key", i),) for i, r in enumerate(rows)]
        return spark.createDataFrame(full, LISTING_DDL)

    return make


def values(df):
    return sorted(map(tuple, df.collect()), key=repr)
