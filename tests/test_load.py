import pytest
from pyspark.sql import functions as F

from shelfprice.operators import load
from shelfprice.schema import RAW_COLUMNS
from tests.conftest import values


def urls(df):
    return sorted((r["product_url"] or "", r["product_name"]) for r in df.collect())


def rows_of(*pairs):
    return [{"product_url": u, "product_name": n, "platform": "p"} for u, n in pairs]


BATCH = rows_of(("a", "1"), ("b", "2"), ("a", "3"), (None, "4"), (None, "5"), ("c", "6"), ("b", "7"))


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_first_wins_keeps_null_urls_and_first_rows(listings, parts):
    df = listings(*BATCH).repartition(parts, F.rand(3))
    assert urls(load.first_wins(df)) == [("", "4"), ("", "5"), ("a", "1"), ("b", "2"), ("c", "6")]


def test_stored_wins_and_second_load_inserts_nothing(listings):
    batch = listings(*BATCH)
    stored = listings(*rows_of(("b", "old"), (None, "old")))
    fresh = load.insert_if_absent(batch, stored)
    assert urls(fresh) == [("", "4"), ("", "5"), ("a", "1"), ("c", "6")]
    again = load.insert_if_absent(batch.where("product_url is not null"), stored.unionByName(fresh))
    assert again.count() == 0


@pytest.mark.parametrize("limit", [100, 0])
def test_reduce_stored_never_changes_the_insert(listings, limit):
    batch, stored = listings(*BATCH), listings(*rows_of(("b", "o"), ("z", "o"), (None, "o")))
    reduced = load.reduce_stored(stored.select("product_url"), batch, limit)
    assert urls(load.insert_if_absent(batch, reduced)) == urls(load.insert_if_absent(batch, stored))


def test_hot_url_is_pruned_on_the_map_side(listings):
    df = listings(*[{"product_url": "hot" if i % 3 == 0 else f"u{i}", "product_name": str(i)} for i in range(300)])
    kept = load.first_wins(df)
    assert kept.count() == 201
    assert kept.where("product_url = 'hot'").first()["product_name"] == "0"


def test_order_key_may_be_a_struct(listings):
    df = listings(*BATCH).withColumn("order_key", F.struct(F.lit("f").alias("path"), (-F.col("order_key")).alias("row")))
    assert urls(load.first_wins(df)) == [("", "4"), ("", "5"), ("a", "3"), ("b", "7"), ("c", "6")]


def test_projection_needs_all_columns(listings):
    df = listings(*BATCH).withColumn("extra", F.lit(1))
    assert load.project_listing(df).columns == [*RAW_COLUMNS, "order_key"]
    with pytest.raises(ValueError, match="rating"):
        load.project_listing(df.drop("rating"))


def bad_rows():
    good = {"platform": "p", "product_name": "n", "current_price": 1.005, "scraped_at": "2024-01-05T10:00:00"}
    return [
        good,
        {**good, "platform": None},
        {**good, "current_price": 99999999.995, "rating": 9.995},
        {**good, "current_price": 99999999.994, "rating": 9.994},
        {**good, "scraped_at": "soon"},
        {**good, "brand": "b" * 256},
        {**good, "discount_pct": -1000.0},
    ]


def test_contract_splits_and_names_reasons(listings):
    df = listings(*bad_rows())
    valid, bad = load.apply_contract(df), load.quarantined(df)
    assert valid.count() == 2 and bad.count() == 5
    assert str(valid.orderBy("order_key").first()["current_price"]) == "1.01"
    reasons = {r["order_key"]: r["violations"] for r in bad.collect()}
    assert reasons == {
        1: ["platform missing"],
        2: ["current_price not decimal(10,2)", "rating not decimal(3,2)"],
        4: ["scraped_at not timestamp_ntz"],
        5: ["brand too long"],
        6: ["discount_pct not decimal(5,2)"],
    }


def test_contract_limits_agree_with_the_cast(spark):
    edge = [99999999.99, 99999999.99499999, 99999999.995, 99999999.9950001, -99999999.995, -99999999.9949, 0.0]
    df = spark.createDataFrame([(x,) for x in edge], "current_price double")
    unfit = load._unfit(df, "current_price")
    castless = F.col("current_price").try_cast("decimal(10,2)").isNull()
    assert df.where(unfit != castless).count() == 0


def test_contract_fail_mode_fails_the_job(listings):
    df = listings(*bad_rows())
    with pytest.raises(Exception, match="listing rejected: platform missing"):
        load.apply_contract(df.where("order_key < 2"), "fail").collect()
    assert load.apply_contract(df.where("order_key = 0"), "fail").count() == 1


def test_counts_and_summary(listings):
    batch = listings(
        {"platform": "A", "product_url": "1"},
        {"platform": "A", "product_url": "1"},
        {"platform": "B", "product_url": "2"},
        {"platform": None, "product_url": "3"},
    )
    stored = listings({"platform": "B", "product_url": "2"}, {"platform": "C", "product_url": "9"})
    assert values(load.load_counts(batch)) == [("A", 2), ("B", 1), ("unknown", 1)]
    summary = load.load_summary(batch, load.insert_if_absent(batch, stored), stored)
    assert values(summary.where("platform is not null")) == [("A", 2, 1, 1), ("B", 1, 0, 1), ("C", 0, 0, 0)]


def test_zero_discount_counts_as_discounted(listings):
    df = listings({"discount_pct": 0.0}, {"discount_pct": None}, {"discount_pct": 5.0})
    assert load.discounted_listings(df).count() == 2


def test_coerce_types(spark):
    raw = spark.createDataFrame(
        [("", "1_000", " 7 ", "x", "12.9", "", "kept ")],
        "brand string, current_price string, original_price string, discount_pct string, review_count string, "
        "rating string, platform string",
    )
    assert tuple(load.coerce_types(raw).first()) == (None, None, 7.0, None, 12, None, "kept ")


def test_numbers_that_are_not_finite_are_rejected_with_a_reason(spark):
    cells = {"platform": "p", "product_name": "n", "scraped_at": "2024-01-05T10:00:00"}
    odd = [("current_price", " NaN "), ("rating", "-inf"), ("review_count", "Infinity"), ("original_price", "1e999"), ("discount_pct", "abc"), ("brand", "nan")]
    rows = [tuple({**cells, c: v}.get(x) for x in RAW_COLUMNS) + (i,) for i, (c, v) in enumerate(odd)]
    text = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS) + ", order_key long")
    typed = load.coerce_types(text, note_not_finite=True)
    bad = load.quarantined(typed)
    assert "not_finite" not in bad.columns
    assert sorted(v for r in bad.collect() for v in r["violations"]) == sorted(f"{c} not finite" for c, _ in odd[:4])
    assert load.apply_contract(typed).columns == [*RAW_COLUMNS, "order_key"]
    kept = load.apply_contract(typed).collect()
    assert {r["order_key"] for r in kept} == {4, 5} and all(r["discount_pct"] is None for r in kept)
    assert load.apply_contract(load.coerce_types(text)).count() == 6


@pytest.mark.parametrize("most_repeated, hot_rows", [(4_000_000, 10_000), (0, 10_000), (0, 1)])
def test_first_wins_by_whatever_way(spark, listings, monkeypatch, most_repeated, hot_rows):
    monkeypatch.setattr(load, "MOST_REPEATED", most_repeated)
    monkeypatch.setattr(load, "HOT_ROWS", hot_rows)
    links = ["a", "b", None, "a", None, "c", "", "", "b", "a", "d"]
    df = listings(*[{"product_url": u, "product_name": str(i), "order_key": 90 - i // 2} for i, u in enumerate(links)])
    kept = [(r.product_url, r.product_name) for r in load.first_wins(df).collect()]
    assert sorted(n for u, n in kept if u is None) == ["2", "4"]
    assert {u for u, _ in kept} == {"a", "b", "c", "d", "", None}
    assert len(kept) == 7 and ("a", "9") in kept and ("b", "8") in kept
    stored = df.where("product_url in ('a', 'd')")
    fresh = [r.product_url for r in load.insert_if_absent(df, stored).collect()]
    assert sorted(fresh, key=str) == ["", None, None, "b", "c"]


def test_rows_of_urls_that_occur_once_are_not_shuffled(spark, listings):
    df = listings(*[{"product_url": u} for u in "abcda"])
    plan = load.first_wins(df)._jdf.queryExecution().executedPlan().toString()
    alone = plan[plan.index("Union") : plan.index("Window [")]
    assert "LeftAnti" in alone and "hashpartitioning" not in alone


@pytest.mark.parametrize("most_repeated", [4_000_000, 0])
def test_rows_without_url_of_one_order_key_are_one_row(listings, monkeypatch, most_repeated):
    monkeypatch.setattr(load, "MOST_REPEATED", most_repeated)
    df = listings(*[{"product_name": n, "order_key": k} for n, k in (("1", 7), ("1", 7), ("2", 8), ("3", None), ("3", None))])
    assert sorted(r.product_name for r in load.first_wins(df).collect()) == ["1", "2", "3"]


def test_rows_that_were_checked_are_not_checked_again(spark, monkeypatch):
    good = {"platform": "p", "product_name": "n", "current_price": "1.5", "scraped_at": "2024-01-05T10:00:00"}
    odd = [{}, {"platform": ""}, {"rating": "inf", "scraped_at": "soon"}, {"current_price": "1e9"}, {"brand": "b" * 256, "product_name": ""}]
    rows = [tuple({**good, **cells}.get(c) for c in RAW_COLUMNS) + (i,) for i, cells in enumerate(odd)]
    typed = load.coerce_types(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS) + ", order_key long"), note_not_finite=True)
    valid, bad = load.apply_contract(typed), load.quarantined(typed)
    expected = (valid.schema, bad.schema, values(valid), values(bad))
    checked = load.check_contract(typed)
    monkeypatch.setattr(load, "contract_checks", None)
    valid, bad = load.apply_contract(checked), load.quarantined(checked)
    assert (valid.schema.names, bad.schema.names) == (expected[0].names, expected[1].names)
    assert (values(valid), values(bad)) == expected[2:] and len(expected[3]) == 4
    with pytest.raises(Exception, match="listing rejected: platform missing"):
        load.apply_contract(checked.where("order_key = 1"), "fail").collect()
    assert load.apply_contract(checked.where("order_key = 0"), "fail").count() == 1
