"""Tables laid out along a curve over several columns."""

import pytest
from pyspark.sql import functions as F

from shelfprice.operators import views
from shelfprice.operators.views import ListingFilter
from shelfprice.schema import RAW_COLUMNS
from shelfprice.sources import clustered
from shelfprice.sources.tables import read_listings, write_cleaned
from tests.conftest import values


@pytest.fixture(scope="module")
def rows(spark):
    h = lambda n: F.pmod(F.xxhash64(F.lit(n), "id"), F.lit(1000))
    df = spark.range(40_000).select(
        F.when(h(1) < 600, "asia").otherwise("a b%/ü").alias("platform"),
        F.concat(F.lit("name "), "id").alias("product_name"),
        F.when(h(2) < 330, "hot").when(h(2) < 340, None).otherwise(F.concat(F.lit("Brand "), h(2))).alias("brand"),
        F.when(h(3) > 5, h(3) / 2 + h(4) / 1000).alias("current_price"),
        F.lit(None).cast("double").alias("original_price"),
        F.when(h(5) > 500, h(5) / 10).alias("discount_pct"),
        F.lit(None).cast("double").alias("rating"),
        F.lit(None).cast("int").alias("review_count"),
        F.concat(F.lit("u"), "id").alias("product_url"),
        F.expr("timestampadd(HOUR, pmod(id * 7919, 9000), TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("scraped_at"),
        F.concat(F.lit("c"), h(6) % 20).alias("category"),
        F.col("id").alias("order_key"),
    )
    return df.cache()


@pytest.fixture(scope="module")
def path(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clustered") / "table")
    write_cleaned(rows, path, cluster_by=clustered.CLUSTER_BY, rows_per_file=400)
    return path


CHOICES = [
    ListingFilter(brands=["Brand 777"], price_min=100, price_max=150),
    ListingFilter(brands=["hot"], price_min=400, price_max=420),
    ListingFilter(brands=["Brand 400", "Brand 900"], price_min=200, price_max=230, min_discount=60),
    ListingFilter(price_min=100, price_max=101, platforms=["a b%/ü"]),
]


@pytest.mark.parametrize("choice", CHOICES)
def test_a_view_equals_the_filter_of_all_rows(spark, rows, path, choice):
    got = views.filter_table(spark, path, choice).select(*RAW_COLUMNS)
    want = views.filter_listings(rows, choice).select(*RAW_COLUMNS)
    assert values(got) == values(want) and want.count()


def test_few_files_are_opened(spark, path):
    everything = len(read_listings(spark, path).inputFiles())
    assert everything >= 90
    shares = [len(views.filter_table(spark, path, c).inputFiles()) / everything for c in CHOICES]
    # Four columns share the cuts of fifty files a platform, so each is cut two or three times.
    assert max(shares[:2]) < 0.45 and max(shares) < 0.7


def test_two_columns_open_a_small_share(spark, rows, tmp_path):
    """A hundred files are cut about seven times along each of two columns, per platform."""
    table = str(tmp_path / "two")
    write_cleaned(rows, table, cluster_by=["brand", "current_price"], rows_per_file=400)
    everything = len(read_listings(spark, table).inputFiles())
    shares = [len(views.filter_table(spark, table, c).inputFiles()) / everything for c in CHOICES[:3]]
    assert max(shares[:2]) < 0.12 and shares[2] < 0.2
    for choice in CHOICES:
        assert values(views.filter_table(spark, table, choice)) == values(views.filter_listings(read_listings(spark, table), choice))


def test_files_are_even_and_a_hot_brand_fills_many(spark, path):
    per_file = read_listings(spark, path).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), F.max(F.col("brand") == "hot").alias("hot"))
    sizes = [r["n"] for r in per_file.collect()]
    assert max(sizes) < 1200 and per_file.where("hot").count() >= 20


def test_nothing_matches_and_other_tables(spark, rows, path, tmp_path):
    assert views.filter_table(spark, path, ListingFilter(price_min=1e9)).count() == 0
    assert read_listings(spark, path).count() == 40_000
    plain = str(tmp_path / "plain")
    write_cleaned(rows.limit(50), plain)
    assert views.filter_table(spark, plain, ListingFilter()).count() == views.filter_listings(rows.limit(50)).count()
    write_cleaned(rows.limit(0), plain, cluster_by=clustered.CLUSTER_BY)
    assert read_listings(spark, plain, {"brand": ["x"]}).count() == 0
    # A clustered table may be replaced by a part of itself.
    write_cleaned(rows, plain, cluster_by=["brand"], rows_per_file=5000)
    write_cleaned(read_listings(spark, plain, {"brand": ["hot"]}).where("brand = 'hot'"), plain, cluster_by=["current_price"])
    assert read_listings(spark, plain).select("brand").distinct().collect() == [("hot",)]


def test_ranks_halve_the_bounds(spark):
    df = spark.createDataFrame([(x,) for x in (None, -5.0, 1.0, 1.5, 2.0, 99.0)], "v double")
    got = [r[0] for r in df.select(clustered._rank(F.col("v"), [1.0, 2.0, 2.0, 7.0], "double")).collect()]
    assert got == [0, 0, 1, 1, 3, 4]
    bounds = [float(i) for i in range(255)]
    many = spark.range(300).select(clustered._rank(F.col("id") - 20.5, bounds, "double").alias("r")).collect()
    assert [r.r for r in many] == [min(255, max(0, i - 20)) for i in range(300)]


def test_bounds_of_all_types(spark, rows):
    bounds = clustered.range_bounds(rows, clustered.CLUSTER_BY)
    keyed = clustered.curve_key(rows, bounds)
    assert {len(b) for b in bounds.values()} == {255} and keyed.columns == [*rows.columns, "_curve"]
    n = keyed.select("_curve").distinct().count()
    assert n > 30_000
    for column, kind in (("scraped_at", "timestamp_ntz"), ("brand", "string")):
        ranks = rows.select(column, clustered._rank(F.col(column), bounds[column], kind).alias("r")).groupBy("r").agg(F.min(column).alias("a"), F.max(column).alias("b"))
        ordered = [(r.a, r.b) for r in ranks.orderBy("r").collect() if r.a is not None]
        assert all(x[1] < y[0] for x, y in zip(ordered, ordered[1:], strict=False)) and len(ordered) > 100


def test_tasks_do_not_follow_the_number_of_files(spark, rows, tmp_path):
    """Four hundred files of a hundred rows, laid out by as many tasks as any shuffle has."""
    assert clustered.along_curve(rows, clustered.CLUSTER_BY, "platform", 100).rdd.getNumPartitions() <= 8
    table = str(tmp_path / "small")
    write_cleaned(rows, table, cluster_by=clustered.CLUSTER_BY, rows_per_file=100)
    sizes = [r[0] for r in read_listings(spark, table).groupBy(F.input_file_name()).agg(F.count("*")).select("count(1)").collect()]
    assert 400 <= len(sizes) <= 420 and max(sizes) == 100


def test_the_curve_has_the_ranks(rows):
    bounds = {**clustered.range_bounds(rows, clustered.CLUSTER_BY), "category": []}
    ranks = {name: clustered._rank(F.col(name), b, dict(rows.dtypes)[name]).cast("long").alias(f"r_{name}") for name, b in bounds.items()}
    # Cached, as a condition on the curve would be pushed into its projections and multiply there.
    keyed = clustered.curve_key(rows, bounds).select("_curve", *ranks.values()).cache()
    for place, name in enumerate(bounds):
        found = sum((F.shiftright("_curve", bit * 4 + place).bitwiseAND(1) * (1 << bit) for bit in range(clustered.BITS)), F.lit(0))
        assert keyed.where(found != F.col(f"r_{name}")).count() == 0


def test_the_code_of_the_curve_stays_short(rows):
    """The bits of a rank are looked up; moved one by one they were most of a projection too long to be compiled well."""
    keyed = clustered.curve_key(rows, clustered.range_bounds(rows, clustered.CLUSTER_BY))
    plan = keyed.select("_curve")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("shiftleft") <= len(clustered.CLUSTER_BY) and "shiftright" not in plan
