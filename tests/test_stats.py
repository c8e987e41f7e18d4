import pytest
from pyspark.sql import functions as F

from shelfprice.operators import charts, deals, stats, views
from shelfprice.operators.views import ListingFilter
from tests.conftest import values


def rows():
    return [
        {"platform": "b", "product_name": "one", "brand": "x", "current_price": 10.0, "discount_pct": 60.0, "category": "c"},
        {"platform": "a", "product_name": "two", "brand": "x", "current_price": 10.0, "discount_pct": 60.0, "category": "c"},
        {"platform": "a", "product_name": "three", "brand": "y", "current_price": 75.0, "discount_pct": None, "category": "c"},
        {"platform": "b", "product_name": "four", "brand": "x", "current_price": 80.0, "discount_pct": 0.0, "category": "c"},
        {"platform": "b", "product_name": "five", "brand": None, "current_price": None, "discount_pct": 100.0, "category": None},
        {"platform": "a", "product_name": "six", "brand": "y", "current_price": -5.0, "discount_pct": 50.0, "category": "d"},
        {"platform": "b", "product_name": "seven", "brand": "y", "current_price": 80.0, "discount_pct": 60.0, "category": "c"},
    ]


@pytest.fixture
def df(listings):
    return listings(*rows())


OPERATORS = [
    stats.platform_overview,
    stats.top_discounted,
    stats.over50_by_platform,
    stats.top_brands_count,
    stats.top_brands_discount,
    stats.top_brands_price,
    stats.with_price_bucket,
    stats.bucket_counts,
    stats.bucket_avg_price,
    stats.price_extremes,
    stats.key_insights,
    charts.price_box_stats,
    charts.price_outliers,
    charts.discount_histogram,
    charts.brand_platform_matrix,
    charts.brand_bubble,
    charts.bucket_share,
    charts.platform_kpi_long,
    deals.genuine_deals,
    views.filter_listings,
    views.avg_discount_by_platform,
    views.display_columns,
]


@pytest.mark.parametrize("operator", OPERATORS, ids=lambda f: f.__name__)
def test_empty_table_gives_no_rows_and_the_same_schema(listings, df, operator):
    empty = operator(listings())
    assert empty.collect() == []
    assert [f.dataType for f in empty.schema] == [f.dataType for f in operator(df).schema]


def test_empty_one_row_answers(listings):
    empty = listings()
    assert tuple(stats.dataset_header(empty).first()) == (0, 0, "")
    assert tuple(stats.discount_distribution(empty).first()) == (None, None, None, None, 0)
    assert tuple(views.kpi_row(empty).first()) == (0, None, None, None)
    assert values(views.filter_options(empty)) == [("max_price", 1, None, 1000.0)]


def test_overview(df):
    assert values(stats.platform_overview(df)) == [("a", 3, 26.67, 55.0, 66.67), ("b", 4, 56.67, 55.0, 100.0)]


def test_distribution(df):
    assert tuple(stats.discount_distribution(df).first()) == (0.0, 100.0, 55.0, 60.0, 4)


def test_ties_follow_the_order_key_not_the_partitioning(df):
    for parts in (1, 4, 64):
        shuffled = df.repartition(parts, F.rand(parts))
        names = [r["product_name"] for r in stats.top_discounted(shuffled, 3).collect()]
        assert names == ["five", "one", "two"]
        extremes = {r["platform"]: r for r in stats.price_extremes(shuffled).collect()}
        assert (extremes["b"]["cheapest_name"], extremes["b"]["dearest_name"]) == ("one", "four")
        assert (extremes["a"]["cheapest_name"], extremes["a"]["dearest_name"]) == ("six", "three")


def test_brand_rankings(df):
    assert [tuple(r) for r in stats.top_brands_count(df).collect()] == [("x", 3), ("y", 3)]
    assert values(stats.top_brands_discount(df)) == [("x", 40.0, 3)]
    assert [tuple(r) for r in stats.top_brands_price(df).collect()] == [("y", 50.0, 3), ("x", 33.33, 3)]


def test_buckets_count_ranged_prices_only(df):
    assert values(stats.bucket_counts(df)) == [(0, "<50", 2), (1, "50-100", 3)]
    assert values(charts.bucket_share(df)) == [(0, "<50", 2, 40.0, 6), (1, "50-100", 3, 60.0, 6)]
    assert sum(r["product_count"] for r in stats.bucket_counts(df).collect()) == 5


def test_insights(df):
    found = {r["insight_no"]: tuple(r)[1:] for r in stats.key_insights(df).collect()}
    assert found == {
        1: ("a", 55.0, None),
        2: ("b", 100.0, None),
        3: (None, 4.0, 57.14),
        4: ("50-100", 3.0, 42.86),
        5: ("b", 56.67, None),
    }
    assert stats.insight_text(stats.key_insights(df)).count() == 5


def test_insights_without_discounts_or_prices(listings):
    bare = listings({"platform": "p", "product_name": "n"})
    numbers = [r["insight_no"] for r in stats.key_insights(bare).collect()]
    assert 1 not in numbers and 5 not in numbers and 3 in numbers


def test_histogram_keeps_the_edge_visible(df):
    assert values(charts.discount_histogram(df)) == [
        ("a", 50, 1),
        ("a", 60, 1),
        ("b", 0, 1),
        ("b", 60, 2),
        ("b", None, 1),
    ]


def test_box_accounts_for_every_price(listings):
    prices = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 100.0, -90.0]
    df = listings(*[{"platform": "p", "product_name": "n", "current_price": p} for p in prices])
    box = charts.price_box_stats(df).first()
    assert (box["q1"], box["median"], box["q3"]) == (2.0, 4.0, 6.0)
    assert (box["low_whisker"], box["high_whisker"], box["outliers"], box["priced"]) == (1.0, 7.0, 2, 9)
    assert sorted(r["current_price"] for r in charts.price_outliers(df).collect()) == [-90.0, 100.0]


def test_matrix_fills_absent_pairs(listings):
    df = listings({"brand": "x", "platform": "a"}, {"brand": "x", "platform": "a"}, {"brand": "y", "platform": "b"})
    assert values(charts.brand_platform_matrix(df)) == [
        ("x", "a", 2, 2),
        ("x", "b", 0, 2),
        ("y", "a", 0, 1),
        ("y", "b", 1, 1),
    ]
    assert values(charts.brand_platform_pivot(df, ["a", "b"])) == [("x", 2, 0), ("y", 0, 1)]
    assert values(charts.brand_platform_matrix(df, 1)) == [("x", "a", 2, 2)]


def test_bubble_scale(df):
    assert values(charts.brand_bubble(df)) == [("x", 33.33, 40.0, 3, 2 * 3 / 1600)]


def test_kpi_long_fills_zero(listings):
    df = listings({"platform": "p", "product_name": "n"})
    assert values(charts.platform_kpi_long(df)) == [
        ("p", "avg_current_price", 0.0),
        ("p", "avg_discount_pct", 0.0),
        ("p", "pct_products_with_discount", 0.0),
    ]


def test_default_filter_drops_missing_and_negative_prices(df):
    assert sorted(r["order_key"] for r in views.filter_listings(df).collect()) == [0, 1, 2, 3, 6]


def test_filter_bounds_are_inclusive(df):
    def keys(**choice):
        return sorted(r["order_key"] for r in views.filter_listings(df, ListingFilter(**choice)).collect())

    assert keys(price_min=10, price_max=75) == [0, 1, 2]
    assert keys(platforms=["a"], price_min=-10) == [1, 2, 5]
    assert keys(brands=["y"]) == [2, 6]
    assert keys(min_discount=60) == [0, 1, 6]
    assert keys(platforms=[]) == []


def test_filter_options(df):
    assert values(views.filter_options(df)) == [
        ("brand", 1, "x", 3.0),
        ("brand", 2, "y", 3.0),
        ("max_price", 1, None, 80.0),
        ("platform", 1, "a", None),
        ("platform", 2, "b", None),
    ]


def test_search(listings):
    df = listings(
        {"product_name": "Red C++ (new)", "brand": None},
        {"product_name": None, "brand": "REDOX"},
        {"product_name": "blue", "brand": "b"},
    )
    assert views.search_listings(df, "  ").count() == 3
    assert views.search_listings(df, " reD").count() == 2
    assert views.search_listings(df, "c++ (").count() == 1
    assert views.search_listings(df, "^re|^b", regex=True).count() == 3
    assert tuple(views.search_counts(df, "red").first()) == (2, 3)
    # Patterns of the engine that runs them, refused before any job.
    for bad in ("(", "a{,2}", "[a[b]"):
        with pytest.raises(ValueError, match="not a pattern"):
            views.search_listings(df, bad, regex=True)


def test_display_columns_keep_order_and_skip_missing(df):
    assert views.display_columns(df.drop("rating")).columns[:3] == ["platform", "brand", "product_name"]
    assert "rating" not in views.display_columns(df.drop("rating")).columns


def test_genuine_deals(df):
    found = {r["order_key"]: (r["category_mean"], r["is_deal"]) for r in deals.genuine_deals(df).collect()}
    assert found == {
        0: (56.67, True),
        1: (42.5, True),
        2: (42.5, False),
        3: (56.67, False),
        5: (-5.0, False),
        6: (56.67, False),
    }
