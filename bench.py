"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the input tables, ``BENCH_CPUS`` the local cores. Each query runs once in one
session and writes its whole result to the no-op sink. ``load_base`` and ``clean_table`` build the
chain's two written tables (fixture -> first-wins -> base table -> cleaned table), ``page_table`` the
captured pages and ``page_cards`` the one parse of them; the queries behind them then read these tables, as every reader after those jobs does.
``load_clean_overview`` runs that chain from the test tables to the overview once more, and twice again
"""

from __future__ import annotations

import json
import os
import sys
import time

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "dedupe_first_wins",
    "insert_if_absent",
    "load_summary",
    "contract_violations",
    "coerce_types",
    "price_p99",
    "cleaned_listings",
    "cleaning_summary",
    "dataset_header",
    "platform_overview",
    "discount_distribution",
    "top_discounted",
    "over50_by_platform",
    "top_brands_count",
    "top_brands_discount",
    "top_brands_price",
    "bucket_counts",
    "bucket_avg_price",
    "price_extremes",
    "key_insights",
    "genuine_deals",
    "price_box_stats",
    "price_outliers",
    "discount_histogram",
    "brand_platform_matrix",
    "brand_bubble",
    "bucket_share",
    "platform_kpi_long",
    "filter_options",
    "filter_listings",
    "kpi_row",
    "search_listings",
    "parse_price",
    "raw_csv_roundtrip",
    "extract_cards",
    "extraction_summary",
    "extraction_errors",
    "clustered_view",
    "empty_view",
    "filtered_box_hazen",
    "incremental_load",
    "loader_summary",
    "replaced_cleaned",
    "load_counts",
    "contract_valid",
    "filtered_top_brands",
    "filtered_bubble",
    "filtered_buckets",
    "filtered_histogram",
    "filtered_box",
    "export_view",
    "report_json",
    "report_rows",
]


def main() -> None:
    from checks import fixture, pages
    from checks.compare import session
    from checks.queries import QUERIES
    from shelfprice.operators.clean import clean
    from shelfprice.operators.load import first_wins
    from shelfprice.operators.stats import platform_overview
    from shelfprice.plans.staging import stage

    spark = session("bench", CPUS)
    spark.sparkContext.setLogLevel("ERROR")

    def chain():
        base = stage(first_wins(fixture.raw_listings(spark, SF_DIR)), "chain")
        return platform_overview(clean(base))

    spark.range(1000).selectExpr("sum(id)").collect()
    jobs = {
        "load_base": lambda: fixture.base_listings(spark, SF_DIR),
        "clean_table": lambda: fixture.cleaned_listings(spark, SF_DIR),
        "page_table": lambda: pages.captured_pages(spark, SF_DIR),
        "page_cards": lambda: pages.page_cards(spark, SF_DIR),
        "load_clean_overview": chain,
        "load_clean_overview_2": chain,
        "load_clean_overview_3": chain,
        **{name: (lambda name=name: QUERIES[name](spark, SF_DIR)) for name in HEADLINE},
    }
    only = sys.argv[1:]
    seconds = {}
    for name, job in jobs.items():
        if only and name not in only:
            continue
        start = time.perf_counter()
        job().write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    result = {"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds}
    print(json.dumps({**result, "sf": float(sf), "cpus": int(CPUS)}))


if __name__ == "__main__":
    main()
