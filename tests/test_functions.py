import pytest
from pyspark.sql import functions as F

from shelfprice.functions import buckets, numeric, parse, text


def apply(spark, make, inputs, ddl):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {ddl}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("x"))).collect()]


def check(spark, make, table, ddl="string"):
    assert apply(spark, make, list(table), ddl) == list(table.values())


def test_rint2(spark):
    table = {2.665: 2.66, 2.675: 2.68, 0.125: 0.12, 0.135: 0.14, 1.005: 1.0, 12.345: 12.34, -2.665: -2.66}
    check(spark, numeric.rint2, table, "double")


def test_number_gate(spark):
    good = {"12.5": 12.5, " 12 ": 12.0, "1e3": 1000.0, "-3": -3.0, ".5": 0.5, "5.": 5.0, "+4": 4.0}
    bad = dict.fromkeys(["12f", "1.5d", "1_000", "nan", "inf", "abc", "", "1e999", "0x1p3", "."])
    check(spark, numeric.to_double, {**good, **bad})


def test_to_whole_truncates(spark):
    check(spark, numeric.to_whole, {"12.9": 12, "-3.7": -3, "1e3": 1000, "x": None, "inf": None, "1e30": None})


def test_exact_sum_ignores_order(spark):
    prices = [0.1, 0.2, 0.3, 1e7, 1e-6, 335.775, -4.25] * 50
    sums = set()
    for parts in (1, 3, 16):
        df = spark.createDataFrame([(p,) for p in prices], "x double").repartition(parts)
        sums.add(df.agg(numeric.exact_sum(F.col("x"))).first()[0])
    assert len(sums) == 1
    assert sums.pop() == pytest.approx(sum(prices), abs=1e-6)
    assert spark.createDataFrame([(None,)], "x double").agg(numeric.exact_mean(F.col("x"))).first()[0] is None


BRANDS = {
    "h&m dress": "H&M",
    "levi's 501": "Levi'S",
    "  Next-dress": "Next",
    "3m tape": "3M",
    "- lead": None,
    "a|b": "A",
    " zara top": "Zara",
    "éclair bag": "Éclair",
    "o/neill": "O",
    "": None,
    "NEXT X": "Next",
    "\x1fnike": "Nike",
    "日本abc": "日本Abc",
    "ąbc2def": "Ąbc2Def",
}


def test_first_word_title(spark):
    check(spark, text.first_word_title, BRANDS)


def test_title_case_equals_str_title(spark):
    words = [w for w in BRANDS if w] + ["o'NEIL-smith", "x1y2z3", "ÀÉÎ õü", "...abc", "МОСКВА город"]
    check(spark, text.title_case, {w: w.title() for w in words})


def test_normalise_platform(spark):
    check(spark, text.normalise_platform, {" ASIA ": "asia", " Z\t": "z", "a b": "a b"})


def test_junk_names(spark):
    table = {None: True, "": True, " x ": True, "97": True, " 123 ": True, "12a": False, "ab": False, "  ": True}
    check(spark, text.is_junk_name, table)


PRICES = {
    "RM1,299.00": (1299.0, 1299.0),
    "RM10.00 - RM50.00": (None, 10.0),
    "From RM49.00": (49.0, 49.0),
    "From RM29.90 - RM59.90": (None, 29.9),
    "RM 147.90": (147.9, 147.9),
    "12 - 20": (1220.0, 12.0),
    "-RM5": (5.0, None),
    "RM1.200.00": (None, None),
    "Free": (None, None),
    ".": (None, None),
    "": (None, None),
    "RM.50": (0.5, 0.5),
    None: (None, None),
}


def test_parse_price(spark):
    check(spark, lambda x: parse.parse_price(x, False), {k: v[0] for k, v in PRICES.items()})
    check(spark, lambda x: parse.parse_price(x, True), {k: v[1] for k, v in PRICES.items()})


def test_parse_discount(spark):
    table = {"-62%": 62.0, "30% Off": 30.0, "12.5%": 12.5, "Up to 1.5.2%": None, "SALE": None, "...": None, "": None}
    check(spark, parse.parse_discount, table)


def test_parse_count(spark):
    table = {
        "(1,234)": 1234,
        "1.2k sold": 1200,
        "2.01K": 2009,
        "12 kids": 12000,
        "3.5": 3,
        "(57)": 57,
        " (8) ": 8,
        ",": None,
        "sold": None,
        "": None,
        "1.2.3k": None,
        None: None,
    }
    check(spark, parse.parse_count, table)


def test_absolutise_url(spark):
    base = "https://s.example"
    kept = {"//c/x": "https://c/x", "/x": f"{base}/x", "http://o/x": "http://o/x", "x": "x", "": "", None: ""}
    rooted = {"//c/x": f"{base}//c/x", "/x": f"{base}/x", "http://o/x": "http://o/x", "x": f"{base}/x", "": f"{base}/"}
    check(spark, lambda x: parse.absolutise_url(x, F.lit(base), True), kept)
    check(spark, lambda x: parse.absolutise_url(x, F.lit(base), False), {**rooted, None: f"{base}/"})
    check(spark, parse.site_root, {"https://a.example:8/b?c": "https://a.example:8", "nothing": ""})


def test_price_bucket(spark):
    table = {
        -1.0: None,
        0.0: "<50",
        49.99: "<50",
        50.0: "50-100",
        200.0: "200-500",
        500.0: "500+",
        1e9: "500+",
        float("inf"): None,
        None: None,
    }
    check(spark, lambda x: buckets.bucket_label(buckets.bucket_ord(x)), table, "double")


def test_discount_bin(spark):
    check(spark, buckets.discount_bin, {0.0: 0, 4.99: 0, 5.0: 5, 99.9: 95, 100.0: None, -1.0: None, None: None}, "double")
