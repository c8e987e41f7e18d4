import datetime
import json
import uuid

import pytest
from pyspark.sql import functions as F

from shelfprice.operators import report, stats
from shelfprice.operators.charts import platform_kpi_long
from shelfprice.schema import RAW_COLUMNS
from shelfprice.sources import csv, reports, tables
from tests.conftest import values


def write(folder, name, text, **kwargs):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8", **kwargs)


def test_cells_bind_by_header_name(spark, tmp_path):
    folder = tmp_path / "raw"
    write(folder, "b.csv", "brand,platform,product_name\nB1,P1,N1\n\nB2,P2,N2,extra cell\nB3\n")
    write(folder, "a.csv", 'platform,product_name,extra\nP0,"two\nlines, ""quoted""",x\n')
    write(folder, "c.csv", "brand,platform,product_name\nB4,P4,N4\n")
    write(folder, "d.csv", "﻿product_name,platform\nN5,P5\n")
    write(folder, "empty.csv", "")
    write(folder, "head.csv", "platform,product_name\n")
    write(folder, "note.txt", "not a drop")
    df = csv.read_raw_csv(spark, str(folder))
    rows = df.orderBy("order_key").select("platform", "product_name", "brand").collect()
    assert [tuple(r) for r in rows] == [
        ("P0", 'two\nlines, "quoted"', None),
        ("P1", "N1", "B1"),
        ("P2", "N2", "B2"),
        (None, None, "B3"),
        ("P4", "N4", "B4"),
        ("P5", "N5", None),
    ]


@pytest.mark.parametrize("limit", [csv.WHOLE_FILE_BYTES, 0, 8])
def test_first_lines_of_small_and_large_files(spark, tmp_path, limit):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, data in {"a": b"x,y\r\n1,2\r\n", "b": b"y,x\n", "c": b"", "d": b"x", "e": b"x,z\n" * 999}.items():
        (folder / f"{name}.csv").write_bytes(data)
    found = {r["path"][-5]: r["header"] for r in csv.first_lines(spark, str(folder), limit).collect()}
    assert found == {"a": "x,y", "b": "y,x", "d": "x", "e": "x,z"}


def test_uniform_header_reads_once_and_rejects_other_headers(spark, tmp_path):
    folder = tmp_path / "raw"
    write(folder, "a.csv", "platform,brand\nP,B\n")
    df = csv.read_raw_csv(spark, str(folder), ["platform", "brand"])
    assert values(df.select("platform", "brand")) == [("P", "B")]
    write(folder, "b.csv", "brand,platform\nB,P\n")
    with pytest.raises(Exception):
        csv.read_raw_csv(spark, str(folder), ["platform", "brand"]).collect()


def test_no_files_gives_an_empty_batch(spark, tmp_path):
    (tmp_path / "none").mkdir()
    df = csv.read_raw_csv(spark, str(tmp_path / "none"))
    assert df.count() == 0 and df.columns == [*RAW_COLUMNS, "order_key"]


def test_csv_round_trip_of_awkward_text(spark, tmp_path, listings):
    df = listings(
        {"platform": " P ", "product_name": 'a "b", c\nd\\', "brand": "Müller", "current_price": 1.5, "review_count": 3},
        {"platform": "Q", "product_name": "\\", "brand": None},
    )
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns if c != "order_key"])
    name = csv.run_name("site", datetime.datetime(2024, 1, 2, 3, 4, 5))
    assert name == "site_fashion_20240102_030405"
    path = csv.write_raw_csv(text, str(tmp_path), name)
    assert csv.write_raw_csv(text.limit(0), str(tmp_path), "empty") == "" and not (tmp_path / "empty").exists()
    back = csv.read_raw_csv(spark, path).drop("order_key")
    assert values(back) == values(text)


def test_cleaned_table_is_replaced(spark, tmp_path, listings):
    path = str(tmp_path / "cleaned table")
    df = listings({"platform": "a", "product_name": "n", "scraped_at": None}, {"platform": "b", "product_name": "m"})
    df = df.withColumn("scraped_at", F.col("scraped_at").try_cast("timestamp_ntz"))
    tables.write_cleaned(df, path)
    both = tables.read_listings(spark, path)
    tables.write_cleaned(both.where("platform = 'a'"), path)
    back = tables.read_listings(spark, path)
    assert back.count() == 1 and dict(back.dtypes)["current_price"] == "double" and back.columns == df.columns
    assert both.count() == 2  # a plan over the version before still reads it
    tables.write_cleaned(back, path, rebalance=False)
    assert values(tables.read_listings(spark, path)) == values(df.where("platform = 'a'"))
    assert sum(p.name.startswith("v-") for p in (tmp_path / "cleaned table").iterdir()) == 2
    plan = back.where("platform = 'a' and current_price > 5")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan and "GreaterThan(current_price,5.0)" in plan


def test_a_failed_write_leaves_the_table(spark, tmp_path, listings):
    path = str(tmp_path / "t")
    tables.write_cleaned(listings({"platform": "a", "product_name": "n"}).withColumn("scraped_at", F.lit(None)), path)
    failing = tables.read_listings(spark, path).withColumn("product_name", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        tables.write_cleaned(failing, path)
    assert tables.read_listings(spark, path).count() == 1


@pytest.mark.parametrize("versioned", [True, False])
def test_platforms_come_back_as_text(spark, tmp_path, listings, versioned):
    names = ["007", "2024-01-01", "1e3", "a=b/c d", *(["", "\u2205", "\u2205x"] if versioned else [])]
    df = listings(*[{"platform": p, "product_name": "n"} for p in names]).withColumn("scraped_at", F.lit(None).cast("timestamp_ntz"))
    path = str(tmp_path / "t")
    if versioned:
        tables.write_cleaned(df, path)
    else:
        df.write.partitionBy("platform").parquet(path)
    back = tables.read_listings(spark, path)
    assert dict(back.dtypes)["platform"] == "string"
    assert sorted(r.platform for r in back.collect()) == sorted(names)
    assert back.where("platform in ('007', '')").count() == (2 if versioned else 1)


def test_export_leaves_out_the_order_key(spark, tmp_path, listings):
    tables.write_export(listings({"product_name": "n"}), str(tmp_path / "x"))
    header = spark.read.text(str(tmp_path / "x")).first()[0]
    assert header.split(",") == RAW_COLUMNS


def report_rows(listings):
    return listings(
        {"platform": "b", "product_name": "Köln", "brand": "x", "current_price": 10.0, "discount_pct": 60.0},
        {"platform": "b", "product_name": "two", "brand": "x", "current_price": 30.0, "discount_pct": None},
        {"platform": "a", "product_name": "three", "brand": "x", "current_price": None, "discount_pct": 20.0},
    )


def test_report_document(spark, tmp_path, listings):
    df = report_rows(listings)
    path = str(tmp_path / "report")
    reports.write_report(df, path, "2024-01-01T00:00:00")
    text = "\n".join(r[0] for r in spark.read.text(path).collect())
    assert "Köln" in text and "\n  " in text
    doc = json.loads(text)
    assert list(doc) == list(report.REPORT_TYPES)
    assert doc["total_rows"] == 3 and doc["generated_at"] == "2024-01-01T00:00:00"
    assert doc["platform_overview"]["a"] == {
        "total_products": 1,
        "avg_current_price": None,
        "avg_discount_pct": 20.0,
        "pct_products_with_discount": 100.0,
    }
    behaviour = doc["discount_behaviour"]
    assert behaviour["distribution"] == {"min": 20.0, "max": 60.0, "mean": 40.0, "median": 40.0, "count_above_50pct": 1}
    assert [r["product_name"] for r in behaviour["top10_most_discounted"]] == ["Köln", "three"]
    assert behaviour["over_50pct_per_platform"] == {"b": 1}
    assert doc["brand_analysis"]["top10_by_product_count"] == [{"brand": "x", "product_count": 3}]
    assert doc["brand_analysis"]["top10_by_avg_price"] == []
    prices = doc["price_analysis"]
    assert prices["bucket_counts"] == [{"price_bucket": "<50", "product_count": 2}]
    assert prices["avg_price_per_platform_per_bucket"] == [{"platform": "b", "price_bucket": "<50", "avg_price": 20.0}]
    assert prices["extremes_per_platform"]["b"]["most_expensive"]["product_name"] == "two"
    assert len(doc["key_insights"]) == 5
    saved = reports.read_report(spark, path)
    assert values(report.kpi_of_report(saved)) == values(platform_kpi_long(df))


def test_report_of_an_empty_table_and_a_missing_report(spark, tmp_path, listings):
    row = report.report(listings()).first()
    assert row["total_rows"] == 0 and row["key_insights"] == []
    missing = reports.read_report(spark, str(tmp_path / "nowhere"))
    assert report.kpi_of_report(missing).count() == 0


def test_profile_serves_overview_and_insights_alike(listings):
    df = report_rows(listings)
    profile = stats.platform_profile(df)
    assert values(stats.insights_of_profile(profile)) == values(stats.key_insights(df))


def jobs_of(spark, work):
    group = f"counted-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "")
    work()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_a_drop_is_written_by_one_job(spark, tmp_path):
    """The input runs once, also when it turns out to be empty."""
    rows = spark.range(100).repartition(3).selectExpr(*[f"cast(id AS string) AS {c}" for c in RAW_COLUMNS])
    rows.count()
    assert jobs_of(spark, lambda: csv.write_raw_csv(rows.coalesce(1), str(tmp_path), "a")) <= 2
    none = spark.range(100).where("id < rand() - 1").selectExpr(*[f"cast(id AS string) AS {c}" for c in RAW_COLUMNS])
    assert jobs_of(spark, lambda: csv.write_raw_csv(none, str(tmp_path), "b")) == 1
    assert (tmp_path / "a").exists() and not (tmp_path / "b").exists()
