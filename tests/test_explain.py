"""Plan shapes that must hold whatever the size of the data."""

import re

import pytest

from checks import fixture as fx
from checks.queries import QUERIES
from shelfprice.operators import charts, clean, stats, views
from shelfprice.operators.views import ListingFilter


def plan_of(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


WRITING = {"clustered_view", "incremental_load", "loaded_extremes", "loader_summary", "replaced_cleaned", "export_view", "report_json", "report_rows", "raw_csv_roundtrip"}
READ_ONLY = sorted(set(QUERIES) - WRITING - {"saved_report_kpi"})


@pytest.mark.parametrize("name", READ_ONLY)
def test_no_cross_joins_and_no_global_windows(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert not re.search(r"Window \[[^\n]*windowspecdefinition\(specifiedwindowframe", plan)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.fixture(scope="module")
def cleaned(spark, sf_dir):
    return fx.cleaned_listings(spark, sf_dir)


def test_filter_reaches_the_scan(cleaned):
    choice = ListingFilter(platforms=["asia"], price_min=50, price_max=500, brands=["x"], min_discount=20)
    plan = plan_of(views.kpi_row(views.filter_listings(cleaned, choice)))
    for pushed in ("GreaterThanOrEqual(current_price,50.0)", "LessThanOrEqual(current_price,500.0)", "EqualTo(brand,x)"):
        assert pushed in plan
    assert "PartitionFilters: [isnotnull(platform" in plan
    assert "ReadSchema: struct<brand:string,current_price:double,discount_pct:double>" in plan


def test_overview_reads_two_columns_and_aggregates_before_the_shuffle(cleaned):
    plan = plan_of(stats.platform_overview(cleaned))
    assert "ReadSchema: struct<current_price:double,discount_pct:double>" in plan
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2 and "SortAggregate" not in plan


def test_insights_scan_once(cleaned):
    assert plan_of(stats.key_insights(cleaned)).count("FileScan") == 1


def test_quantiles_scan_once(spark, sf_dir):
    plan = plan_of(clean.price_caps(fx.base_listings(spark, sf_dir)), run=True)
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_bubble_reuses_its_exchange(cleaned):
    assert "ReusedExchange" in plan_of(charts.brand_bubble(cleaned), run=True)


def test_cleaning_does_not_shuffle_the_rows(spark, sf_dir):
    plan = plan_of(clean.clean(fx.base_listings(spark, sf_dir)))
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
