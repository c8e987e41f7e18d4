"""Registered queries, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixture as fx
from checks import pages, sql
from checks.sql import CLEANED, KEY, LISTING_COLUMNS, LISTINGS, UP_TO, bucket, first_wins, label, mean, over, r2, r6, raw
from shelfprice.functions.numeric import rint2
from shelfprice.functions.parse import (
    absolutise_url,
    assign_prices,
    parse_count,
    parse_discount,
    parse_price,
    parse_rating,
)
from shelfprice.operators import charts, clean, deals, extract, load, report, stats, views
from shelfprice.operators.views import ListingFilter
from shelfprice.plans import sketches
from shelfprice.plans.joins import attach_groups
from shelfprice.plans.staging import new_path, stage
from shelfprice.schema import CLEANED_TYPES, DISPLAY_COLUMNS, ORDER_KEY, RAW_COLUMNS
from shelfprice.sources.clustered import CLUSTER_BY
from shelfprice.sources.csv import read_raw_csv, write_raw_csv
from shelfprice.sources.reports import read_report, write_report
from shelfprice.sources.tables import read_listings, write_cleaned, write_export
from shelfprice.streaming.incremental import FILES_PER_LOAD, load_drops, read_loaded, read_summary

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, query: Query, twin: str | None = None) -> None:
    QUERIES[name] = query
    if twin is not None:
        ORACLES[name] = twin


def on_base(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: operator(fx.base_listings(spark, sf))


def on_cleaned(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: operator(fx.cleaned_listings(spark, sf))


def _listing_columns(df: DataFrame) -> DataFrame:
    return df.select(*RAW_COLUMNS)


# --- load ------------------------------------------------------------------------------------

_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_LINE_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _by_line(texts: list[Column | str]) -> Column:
    """One of several texts per row, chosen by line number."""
    options = F.array(*[t if isinstance(t, Column) else F.lit(t) for t in texts])
    return F.get(options, (F.col("l_linenumber") % len(texts)).cast("int"))


def _by_line_sql(texts: list[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(texts))
    return f"CASE l_linenumber%{len(texts)} {cases} END"


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "lineitem")


def _coerce_input(spark: SparkSession, sf: str) -> DataFrame:
    part, supp = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    return _lines(spark, sf).select(
        *_LINE,
        _by_line([part, F.concat(F.lit(" "), part, F.lit(".25 ")), F.concat(part, F.lit("f")), "1_000", ""]).alias(
            "current_price"
        ),
        _by_line([F.concat(supp, F.lit("e2")), "nan", "-inf", F.concat(F.lit("."), supp)]).alias("original_price"),
        _by_line([F.concat(F.lit("-"), supp, F.lit(".5")), "abc", F.concat(supp, F.lit("."))]).alias("discount_pct"),
        _by_line(["4.5", "1.5d", " +3 ", ""]).alias("rating"),
        _by_line([F.concat(part, F.lit(".9")), F.concat(F.lit("-"), part, F.lit(".9")), "inf", "x", ""]).alias(
            "review_count"
        ),
        _by_line(["", "brand"]).alias("brand"),
    )


def coerce_types(spark: SparkSession, sf: str) -> DataFrame:
    return load.coerce_types(_coerce_input(spark, sf))


def _to_double_sql(text: str) -> str:
    pattern = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
    return f"CASE WHEN regexp_matches({text}, '{pattern}') THEN TRY_CAST(trim({text}) AS DOUBLE) END"


register(
    "coerce_types",
    coerce_types,
    f"""WITH t AS (SELECT {_LINE_SQL},
  {_by_line_sql(["l_partkey||''", "' '||l_partkey||'.25 '", "l_partkey||'f'", "'1_000'", "''"])} AS a,
  {_by_line_sql(["l_suppkey||'e2'", "'nan'", "'-inf'", "'.'||l_suppkey"])} AS b,
  {_by_line_sql(["'-'||l_suppkey||'.5'", "'abc'", "l_suppkey||'.'"])} AS c,
  {_by_line_sql(["'4.5'", "'1.5d'", "' +3 '", "''"])} AS d,
  {_by_line_sql(["l_partkey||'.9'", "'-'||l_partkey||'.9'", "'inf'", "'x'", "''"])} AS e,
  {_by_line_sql(["''", "'brand'"])} AS f FROM lineitem)
SELECT {_LINE_SQL}, {_to_double_sql('a')} AS current_price, {_to_double_sql('b')} AS original_price,
  {_to_double_sql('c')} AS discount_pct, {_to_double_sql('d')} AS rating,
  CAST(trunc({_to_double_sql('e')}) AS BIGINT) AS review_count, nullif(f,'') AS brand FROM t""",
)


def _contract_input(spark: SparkSession, sf: str) -> DataFrame:
    def when(n: int, column: str, broken: Column) -> Column:
        return F.when(F.col(f"{ORDER_KEY}.l_orderkey") % n == 0, broken).otherwise(F.col(column)).alias(column)

    df = fx.raw_listings(spark, sf)
    broken = {
        "platform": when(61, "platform", F.lit(None)),
        "product_name": when(67, "product_name", F.lit(None)),
        "brand": when(79, "brand", F.repeat(F.lit("b"), 256)),
        "current_price": when(59, "current_price", F.col("current_price") * 1e9),
        "discount_pct": when(73, "discount_pct", F.lit(999.995)),
        "rating": when(71, "rating", F.lit(12.345)),
        "review_count": when(83, "review_count", F.lit(3000000000)),
    }
    odd = F.when(F.col(f"{ORDER_KEY}.l_orderkey") % 89 == 0, F.element_at(F.array(*map(F.lit, ("nan", " -INF", "Infinity"))), F.col(f"{ORDER_KEY}.l_linenumber").cast("int") % 3 + 1))
    broken["original_price"] = F.coalesce(odd, F.col("original_price").cast("string")).alias("original_price")
    text = df.select(*[broken.get(c, F.col(c)).cast("string").alias(c) for c in RAW_COLUMNS], ORDER_KEY)
    return load.coerce_types(text, note_not_finite=True)


def contract_violations(spark: SparkSession, sf: str) -> DataFrame:
    bad = load.quarantined(_contract_input(spark, sf))
    return bad.select("product_url", F.array_join("violations", ", ").alias("violations"))


def _broken_sql(n: int, column: str, broken: str) -> str:
    return f"CASE WHEN l_orderkey%{n}=0 THEN {broken} ELSE {column} END AS {column}"


register(
    "contract_violations",
    contract_violations,
    f"""WITH {raw()}, b AS (SELECT * REPLACE ({_broken_sql(61, 'platform', 'NULL')},
  {_broken_sql(67, 'product_name', 'NULL')}, {_broken_sql(79, 'brand', "repeat('b', 256)")},
  {_broken_sql(59, 'current_price', 'current_price*1e9')}, {_broken_sql(73, 'discount_pct', '999.995')},
  {_broken_sql(71, 'rating', '12.345')}, {_broken_sql(83, 'review_count', '3000000000')},
  {_broken_sql(89, 'original_price', 'NULL')}) FROM raw),
v AS (SELECT product_url, concat_ws(', ',
  CASE WHEN platform IS NULL THEN 'platform missing' END,
  CASE WHEN length(platform)>50 THEN 'platform too long' END,
  CASE WHEN product_name IS NULL THEN 'product_name missing' END,
  CASE WHEN length(brand)>255 THEN 'brand too long' END,
  CASE WHEN abs(current_price)>=99999999.995 THEN 'current_price not decimal(10,2)' END,
  CASE WHEN abs(original_price)>=99999999.995 THEN 'original_price not decimal(10,2)' END,
  CASE WHEN l_orderkey%89=0 THEN 'original_price not finite' END,
  CASE WHEN abs(discount_pct)>=999.995 THEN 'discount_pct not decimal(5,2)' END,
  CASE WHEN abs(rating)>=9.995 THEN 'rating not decimal(3,2)' END,
  CASE WHEN review_count>2147483647 THEN 'review_count not int' END,
  CASE WHEN TRY_CAST(scraped_at AS TIMESTAMP) IS NULL THEN 'scraped_at not timestamp_ntz' END,
  CASE WHEN length(category)>100 THEN 'category too long' END) AS violations FROM b)
SELECT product_url, violations FROM v WHERE violations<>''""",
)


def _valid_input(spark: SparkSession, sf: str) -> DataFrame:
    return load.apply_contract(_contract_input(spark, sf)).select(*RAW_COLUMNS)


register(
    "contract_valid",
    _valid_input,
    f"""WITH {raw()} SELECT platform, product_name, brand,
  CAST(CAST(current_price AS VARCHAR) AS DECIMAL(10,2)) AS current_price,
  CAST(CAST(original_price AS VARCHAR) AS DECIMAL(10,2)) AS original_price,
  CAST(CAST(discount_pct AS VARCHAR) AS DECIMAL(5,2)) AS discount_pct,
  CAST(CAST(rating AS VARCHAR) AS DECIMAL(3,2)) AS rating, review_count, product_url,
  CAST(scraped_at AS TIMESTAMP) AS scraped_at, category FROM raw
WHERE l_orderkey%61<>0 AND l_orderkey%67<>0 AND l_orderkey%79<>0 AND l_orderkey%73<>0 AND l_orderkey%71<>0
  AND l_orderkey%83<>0 AND l_orderkey%53<>0 AND l_orderkey%89<>0 AND NOT (l_orderkey%59=0 AND coalesce(current_price*1e9>=99999999.995, false))""",
)


def dedupe_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    return _listing_columns(load.first_wins(fx.raw_listings(spark, sf, missing_urls=True)))


register(
    "dedupe_first_wins",
    dedupe_first_wins,
    over(",".join([raw(True), first_wins()]), f"SELECT {LISTING_COLUMNS} FROM listings"),
)


_LOADED_BEFORE = "1998-01-01"


def _stored(raw_: DataFrame) -> DataFrame:
    """What an earlier load of the captures up to a date has stored."""
    return load.first_wins(raw_.where(F.col("scraped_at") < _LOADED_BEFORE))


def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    batch = fx.raw_listings(spark, sf, missing_urls=True)
    return _listing_columns(load.insert_if_absent(batch, _stored(batch)))


_INSERT = ",".join(
    [
        raw(True),
        f"earlier AS (SELECT * FROM raw WHERE scraped_at<'{_LOADED_BEFORE}')",
        first_wins("earlier", "stored"),
        "candidates AS (SELECT * FROM raw WHERE product_url IS NULL OR product_url NOT IN "
        "(SELECT product_url FROM stored WHERE product_url IS NOT NULL))",
        first_wins("candidates", "inserted"),
    ]
)
register("insert_if_absent", insert_if_absent, over(_INSERT, f"SELECT {LISTING_COLUMNS} FROM inserted"))

register(
    "load_counts",
    lambda spark, sf: load.load_counts(fx.raw_listings(spark, sf)),
    over(raw(), "SELECT platform, count(*) AS listings FROM raw GROUP BY platform"),
)


def load_summary(spark: SparkSession, sf: str) -> DataFrame:
    batch = fx.raw_listings(spark, sf, missing_urls=True)
    stored = _stored(batch)
    return load.load_summary(batch, load.insert_if_absent(batch, stored), stored)


register(
    "load_summary",
    load_summary,
    over(
        _INSERT,
        """SELECT platform, CAST(sum(o) AS BIGINT) AS offered, CAST(sum(i) AS BIGINT) AS inserted,
  CAST(sum(o)-sum(i) AS BIGINT) AS skipped
FROM (SELECT platform, 1 AS o, 0 AS i FROM raw UNION ALL SELECT platform, 0, 1 FROM inserted
  UNION ALL SELECT platform, 0, 0 FROM stored) q GROUP BY platform""",
    ),
)

register(
    "discounted_listings",
    on_base(lambda df: _listing_columns(load.discounted_listings(df))),
    over(LISTINGS, f"SELECT {LISTING_COLUMNS} FROM listings WHERE discount_pct IS NOT NULL"),
)

# --- text of cards ---------------------------------------------------------------------------

_NBSP = "\u00a0"


def _with_text(spark: SparkSession, sf: str, texts: list, name: str = "text") -> DataFrame:
    return _lines(spark, sf).select(*_LINE, _by_line(texts).alias(name))


def _price_texts() -> list:
    price = F.format_number(rint2(F.col("l_extendedprice") / F.col("l_quantity") / 20), 2)
    other = F.format_number(F.col("l_quantity") * 100, 2)
    return [
        F.concat(F.lit("RM"), price),
        F.concat(F.lit("From RM"), price),
        F.concat(F.lit("RM"), price, F.lit(" - RM"), other),
        F.concat(F.lit("RM" + _NBSP), price),
        "Free",
        F.concat(F.lit("RM"), price, F.lit(".00")),
        F.concat(F.lit("-RM"), price),
    ]


_P = f"format('{{:,.2f}}', {r2(sql.UNIT)})"
_P2 = "format('{:,.2f}', l_quantity*100)"


def _price_sql(text: str) -> str:
    return f"TRY_CAST(nullif(regexp_replace({text}, '[^0-9.]', '', 'g'), '') AS DOUBLE)"


register(
    "parse_price",
    lambda spark, sf: _with_text(spark, sf, _price_texts()).select(
        *_LINE,
        "text",
        parse_price(F.col("text"), True).alias("cut_price"),
        parse_price(F.col("text"), False).alias("whole_price"),
    ),
    f"""WITH t AS (SELECT {_LINE_SQL}, {_by_line_sql([f"'RM'||{_P}", f"'From RM'||{_P}", f"'RM'||{_P}||' - RM'||{_P2}",
      f"'RM{_NBSP}'||{_P}", "'Free'", f"'RM'||{_P}||'.00'", f"'-RM'||{_P}"])} AS text FROM lineitem)
SELECT *, {_price_sql("split_part(text, '-', 1)")} AS cut_price, {_price_sql('text')} AS whole_price FROM t""",
)

def _discount_texts() -> list:
    supp = F.col("l_suppkey").cast("string")
    return [
        F.concat(F.lit("-"), supp, F.lit("%")),
        F.concat(supp, F.lit("% Off")),
        F.concat(F.lit("Up to "), supp, F.lit(".5.2%")),
        F.concat(supp, F.lit(".5%")),
        "SALE",
        "...",
        "",
    ]


_DISCOUNT_TEXTS_SQL = _by_line_sql(
    [
        "'-'||l_suppkey||'%'",
        "l_suppkey||'% Off'",
        "'Up to '||l_suppkey||'.5.2%'",
        "l_suppkey||'.5%'",
        "'SALE'",
        "'...'",
        "''",
    ]
)
_FIRST_NUMBER_SQL = "TRY_CAST(nullif(regexp_extract(text, '[0-9.]+'), '') AS DOUBLE)"
register(
    "parse_discount",
    lambda spark, sf: _with_text(spark, sf, _discount_texts()).select(
        *_LINE, "text", parse_discount(F.col("text")).alias("discount_pct")
    ),
    f"WITH t AS (SELECT {_LINE_SQL}, {_DISCOUNT_TEXTS_SQL} AS text FROM lineitem) "
    f"SELECT *, {_FIRST_NUMBER_SQL} AS discount_pct FROM t",
)


def _rating_texts() -> list:
    stars, supp = F.format_number(1 + F.col("l_linenumber") / 2, 1), F.col("l_suppkey").cast("string")
    return [
        F.concat(stars, F.lit("/5")),
        F.concat(F.lit("Rated "), stars),
        F.concat(F.lit("4.."), supp),
        "no rating",
        F.concat(F.lit("("), supp, F.lit(")")),
    ]


_STARS_SQL = "format('{:.1f}', 1+l_linenumber/2)"
register(
    "parse_rating",
    lambda spark, sf: _with_text(spark, sf, _rating_texts()).select(
        *_LINE, "text", parse_rating(F.col("text")).alias("rating")
    ),
    f"""WITH t AS (SELECT {_LINE_SQL}, {_by_line_sql([f"{_STARS_SQL}||'/5'", f"'Rated '||{_STARS_SQL}",
      "'4..'||l_suppkey", "'no rating'", "'('||l_suppkey||')'"])} AS text FROM lineitem)
SELECT *, {_FIRST_NUMBER_SQL} AS rating FROM t""",
)


def _count_texts() -> list:
    supp = F.col("l_suppkey")
    thousands = F.concat(
        F.floor(supp / 100).cast("string"), F.lit("."), F.lpad((supp % 100).cast("string"), 2, "0")
    )
    return [
        F.concat(F.lit("("), F.format_number(F.col("l_partkey"), 0), F.lit(")")),
        F.concat(thousands, F.lit("k sold")),
        F.concat(thousands, F.lit(" K")),
        F.concat(supp.cast("string"), F.lit(" kids")),
        F.concat(thousands, F.lit(" sold")),
        F.concat(F.lit("1."), thousands, F.lit("k")),
        ", sold",
    ]


_C = "format('{:,}', l_partkey)"
_K = "(l_suppkey//100)||'.'||lpad((l_suppkey%100)||'', 2, '0')"
register(
    "parse_count",
    lambda spark, sf: _with_text(spark, sf, _count_texts()).select(
        *_LINE, "text", parse_count(F.col("text")).alias("review_count")
    ),
    f"""WITH t AS (SELECT {_LINE_SQL}, {_by_line_sql([f"'('||{_C}||')'", f"{_K}||'k sold'", f"{_K}||' K'",
      "l_suppkey||' kids'", f"{_K}||' sold'", f"'1.'||{_K}||'k'", "', sold'"])} AS text FROM lineitem)
SELECT *, CASE WHEN regexp_matches(text, '(?i)[0-9.]+\\s*k')
  THEN CAST(trunc(TRY_CAST(regexp_extract(text, '(?i)([0-9.]+)\\s*k', 1) AS DOUBLE)*1000) AS BIGINT)
  ELSE TRY_CAST(nullif(replace(regexp_extract(text, '[0-9,]+'), ',', ''), '') AS BIGINT) END AS review_count FROM t""",
)


def _hrefs() -> list:
    item = F.concat(F.lit("item/"), F.col("l_partkey"))
    return [
        F.concat(F.lit("//cdn.example/"), item),
        F.concat(F.lit("/"), item),
        F.concat(F.lit("https://other.example/"), item),
        item,
        "",
    ]


_BASE = "https://shop.example"
_I = "'item/'||l_partkey"
register(
    "absolutise_url",
    lambda spark, sf: _with_text(spark, sf, _hrefs(), "href").select(
        *_LINE,
        "href",
        absolutise_url(F.col("href"), F.lit(_BASE), True).alias("kept_url"),
        absolutise_url(F.col("href"), F.lit(_BASE), False).alias("rooted_url"),
    ),
    f"""WITH t AS (SELECT {_LINE_SQL}, {_by_line_sql([f"'//cdn.example/'||{_I}", f"'/'||{_I}",
      f"'https://other.example/'||{_I}", _I, "''"])} AS href FROM lineitem)
SELECT *, CASE WHEN href LIKE '//%' THEN 'https:'||href WHEN href LIKE '/%' THEN '{_BASE}'||href ELSE href END AS kept_url,
  CASE WHEN href LIKE '/%' THEN '{_BASE}'||href WHEN href LIKE 'http%' THEN href ELSE '{_BASE}/'||href END AS rooted_url
FROM t""",
)


def _sale_and_regular(spark: SparkSession, sf: str) -> DataFrame:
    sale = F.when(F.col("l_returnflag") == "R", rint2(F.col("l_extendedprice") * (1 - F.col("l_discount"))))
    regular = F.when(F.col("l_linenumber") != 5, rint2(F.col("l_extendedprice")))
    return _lines(spark, sf).select(*_LINE, sale.alias("sale"), regular.alias("regular"))


def assign_sale_prices(spark: SparkSession, sf: str) -> DataFrame:
    current, original = assign_prices(F.col("sale"), F.col("regular"))
    return _sale_and_regular(spark, sf).select(*_LINE, current.alias("current_price"), original.alias("original_price"))


register(
    "assign_prices",
    assign_sale_prices,
    f"""WITH t AS (SELECT {_LINE_SQL}, CASE WHEN l_returnflag='R' THEN {r2('l_extendedprice*(1-l_discount)')} END AS sale,
  CASE WHEN l_linenumber<>5 THEN {r2('l_extendedprice')} END AS regular FROM lineitem)
SELECT {_LINE_SQL}, CASE WHEN sale IS NOT NULL THEN sale ELSE regular END AS current_price,
  CASE WHEN sale IS NOT NULL THEN regular END AS original_price FROM t""",
)

# --- cleaning --------------------------------------------------------------------------------


def _after(step: clean.Step, *columns: str) -> Query:
    """The table after the steps up to and including ``step``."""
    steps = clean.STEPS[: clean.STEPS.index(step) + 1]
    return on_base(lambda df: clean.clean(df, steps).select(*columns))


register(
    "clean_platform",
    _after(clean.NORMALISE_PLATFORM, "product_url", "platform"),
    over(UP_TO[1], "SELECT product_url, platform FROM c1"),
)
register(
    "clean_brand_fill",
    _after(clean.FILL_BRAND, "product_url", "platform", "product_name", "brand"),
    over(UP_TO[2], "SELECT product_url, platform, product_name, brand FROM c2"),
)
register(
    "price_p99",
    on_base(lambda df: clean.price_caps(clean.clean(df, [clean.NORMALISE_PLATFORM]))),
    over(UP_TO[3], "SELECT platform, p99 FROM caps"),
)
register(
    "clean_price_cap",
    _after(clean.CAP_PRICE, "product_url", "platform", "current_price"),
    over(UP_TO[3], "SELECT product_url, platform, current_price FROM c3"),
)
register(
    "clean_discount_fill",
    _after(clean.FILL_DISCOUNT, "product_url", "current_price", "original_price", "discount_pct"),
    over(UP_TO[4], "SELECT product_url, current_price, original_price, discount_pct FROM c4"),
)
register(
    "clean_original_fill",
    _after(clean.FILL_ORIGINAL, "product_url", "current_price", "original_price", "discount_pct"),
    over(UP_TO[5], "SELECT product_url, current_price, original_price, discount_pct FROM c5"),
)
register(
    "clean_scraped_at",
    on_base(lambda df: clean.clean(df, [clean.PARSE_CAPTURE_TIME]).select("product_url", "scraped_at")),
    over(UP_TO[6], "SELECT product_url, scraped_at FROM c6"),
)
register(
    "clean_junk_drop",
    on_base(lambda df: clean.clean(df, [clean.DROP_JUNK]).select("product_url", "product_name")),
    over(CLEANED, "SELECT product_url, product_name FROM cleaned"),
)
register(
    "cleaned_listings",
    on_base(lambda df: _listing_columns(clean.clean(df))),
    over(CLEANED, f"SELECT {LISTING_COLUMNS} FROM cleaned"),
)
register(
    "cleaning_summary",
    on_base(clean.cleaning_summary),
    over(
        CLEANED,
        f"""SELECT count(*) AS rows_before, count(*) FILTER (NOT {sql.JUNK}) AS rows_after,
  count(*) FILTER ({sql.JUNK}) AS rows_dropped, count(*) FILTER (hit_platform) AS normalize_platform,
  count(*) FILTER (hit_brand) AS fill_brand_from_name, count(*) FILTER (hit_cap) AS cap_price_outliers,
  count(*) FILTER (hit_discount) AS fill_discount_pct, count(*) FILTER (hit_original) AS fill_original_price,
  count(*) FILTER (hit_time) AS parse_scraped_at, count(*) FILTER ({sql.JUNK}) AS drop_junk_names FROM c6""",
    ),
)

# --- statistics ------------------------------------------------------------------------------


def _stat(name: str, operator: Callable[[DataFrame], DataFrame], select: str) -> None:
    register(name, on_cleaned(operator), over(CLEANED, select))


_stat(
    "dataset_header",
    stats.dataset_header,
    """SELECT count(*) AS total_rows, count(DISTINCT platform) AS platform_count,
  (SELECT string_agg(platform, ', ' ORDER BY platform) FROM (SELECT DISTINCT platform FROM cleaned) p) AS platforms
FROM cleaned""",
)
OVERVIEW = f"""SELECT platform, count(*) AS total_products, {r2(mean('current_price'))} AS avg_current_price,
  {r2(mean('discount_pct'))} AS avg_discount_pct, {r2('count(discount_pct)/count(*)*100')} AS pct_products_with_discount
FROM cleaned GROUP BY platform"""
_stat("platform_overview", stats.platform_overview, OVERVIEW)
_stat(
    "discount_distribution",
    stats.discount_distribution,
    f"""SELECT {r2('min(discount_pct)')} AS min, {r2('max(discount_pct)')} AS max, {r2(mean('discount_pct'))} AS mean,
  {r2('median(discount_pct)')} AS median, count(*) FILTER (discount_pct>50) AS count_above_50pct FROM cleaned""",
)
_stat(
    "top_discounted",
    stats.top_discounted,
    f"""SELECT platform, brand, product_name, current_price, discount_pct FROM cleaned WHERE discount_pct IS NOT NULL
ORDER BY discount_pct DESC, {KEY} LIMIT 10""",
)
_stat(
    "over50_by_platform",
    stats.over50_by_platform,
    "SELECT platform, count(*) AS listings FROM cleaned WHERE discount_pct>50 GROUP BY platform",
)
_TOP_BRANDS = """SELECT brand, count(*) AS product_count FROM {source} WHERE brand IS NOT NULL GROUP BY brand
ORDER BY product_count DESC, brand LIMIT {n}"""
_stat("top_brands_count", stats.top_brands_count, _TOP_BRANDS.format(source="cleaned", n=10))


def _top_mean_sql(column: str, alias: str) -> str:
    return f"""SELECT brand, {r2(r6('m'))} AS {alias}, n AS count FROM (
  SELECT brand, {mean(column)} AS m, count({column}) AS n FROM cleaned WHERE brand IS NOT NULL GROUP BY brand) q
WHERE n>=3 ORDER BY m DESC, brand LIMIT 10"""


_stat("top_brands_discount", stats.top_brands_discount, _top_mean_sql("discount_pct", "avg_discount"))
_stat("top_brands_price", stats.top_brands_price, _top_mean_sql("current_price", "avg_price"))
_stat(
    "price_bucket",
    lambda df: stats.with_price_bucket(df).select("product_url", "current_price", "bucket_ord", "price_bucket"),
    f"SELECT product_url, current_price, {bucket()} AS bucket_ord, {label(f'({bucket()})')} AS price_bucket FROM cleaned",
)
_BUCKETS = f"(SELECT *, {bucket()} AS bucket_ord FROM {{source}}) q WHERE bucket_ord IS NOT NULL"
_stat(
    "bucket_counts",
    stats.bucket_counts,
    f"""SELECT bucket_ord, {label('bucket_ord')} AS price_bucket, count(*) AS product_count
FROM {_BUCKETS.format(source='cleaned')} GROUP BY bucket_ord""",
)
_stat(
    "bucket_avg_price",
    stats.bucket_avg_price,
    f"""SELECT platform, bucket_ord, {label('bucket_ord')} AS price_bucket, {r2(mean('current_price'))} AS avg_price
FROM {_BUCKETS.format(source='cleaned')} GROUP BY platform, bucket_ord""",
)
register(
    "event_bucket_counts",
    lambda spark, sf: stats.bucket_counts(clean.clean(fx.event_listings(spark, sf), [clean.CAP_PRICE])),
    f"""WITH listings AS (SELECT event_type AS platform, "value" AS current_price FROM events),
caps AS (SELECT platform, {sql.P99} AS p99 FROM listings GROUP BY platform),
capped AS (SELECT least(current_price, p99) AS current_price FROM listings JOIN caps USING (platform))
SELECT bucket_ord, {label('bucket_ord')} AS price_bucket, count(*) AS product_count
FROM {_BUCKETS.format(source='capped')} GROUP BY bucket_ord""",
)
_stat(
    "price_extremes",
    stats.price_extremes,
    f"""SELECT lo.platform, lo.product_name AS cheapest_name, lo.brand AS cheapest_brand, lo.current_price AS cheapest_price,
  hi.product_name AS dearest_name, hi.brand AS dearest_brand, hi.current_price AS dearest_price
FROM (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY current_price, {KEY}) AS r
      FROM cleaned WHERE current_price IS NOT NULL) lo
JOIN (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY current_price DESC, {KEY}) AS r
      FROM cleaned WHERE current_price IS NOT NULL) hi
  ON lo.platform=hi.platform AND lo.r=1 AND hi.r=1""",
)
_stat(
    "key_insights",
    stats.key_insights,
    f"""SELECT * FROM (SELECT 1 AS insight_no, platform AS subject, avg_discount_pct AS "value", NULL::DOUBLE AS share
  FROM ({OVERVIEW}) o WHERE avg_discount_pct IS NOT NULL ORDER BY avg_discount_pct DESC, platform LIMIT 1)
UNION ALL SELECT * FROM (SELECT 2, platform, pct_products_with_discount, NULL
  FROM ({OVERVIEW}) o ORDER BY pct_products_with_discount DESC, platform LIMIT 1)
UNION ALL SELECT 3, NULL, CAST(count(*) FILTER (discount_pct>50) AS DOUBLE),
  {r2('count(*) FILTER (discount_pct>50)/count(*)*100')} FROM cleaned
UNION ALL SELECT * FROM (SELECT 4, {label('bucket_ord')}, CAST(count(*) AS DOUBLE),
  {r2('count(*)/(SELECT count(*) FROM cleaned)*100')}
  FROM {_BUCKETS.format(source='cleaned')} GROUP BY bucket_ord ORDER BY count(*) DESC, bucket_ord LIMIT 1)
UNION ALL SELECT * FROM (SELECT 5, platform, avg_current_price, NULL
  FROM ({OVERVIEW}) o WHERE avg_current_price IS NOT NULL ORDER BY avg_current_price DESC, platform LIMIT 1)""",
)
_stat(
    "genuine_deals",
    lambda df: deals.genuine_deals(df).select(
        "product_url", "platform", "category", "current_price", "category_mean", "is_deal"
    ),
    f"""SELECT product_url, platform, category, current_price, {r2('m')} AS category_mean, current_price<m AS is_deal
FROM cleaned JOIN (SELECT platform, category, {r6(mean('current_price'))} AS m FROM cleaned GROUP BY ALL) g
  USING (platform, category) WHERE current_price IS NOT NULL""",
)

# --- chart datasets --------------------------------------------------------------------------


def _quartiles_sql(source: str) -> str:
    q = {n: r6(f"quantile_cont(current_price, {p})") for n, p in charts.QUARTILES.items()}
    return f"""SELECT platform, q1, median, q3, {r6('q1-(q3-q1)*1.5')} AS low, {r6('q3+(q3-q1)*1.5')} AS high FROM (
  SELECT platform, {q['q1']} AS q1, {q['median']} AS median, {q['q3']} AS q3 FROM {source}
  WHERE current_price IS NOT NULL GROUP BY platform) q"""


def _box_sql(source: str, quartiles: Callable[[str], str] = _quartiles_sql) -> str:
    return f"""SELECT platform, q1, median, q3,
  min(current_price) FILTER (current_price BETWEEN low AND high) AS low_whisker,
  max(current_price) FILTER (current_price BETWEEN low AND high) AS high_whisker,
  count(*) FILTER (current_price NOT BETWEEN low AND high) AS outliers, count(*) AS priced
FROM {source} JOIN ({quartiles(source)}) b USING (platform) WHERE current_price IS NOT NULL
GROUP BY platform, q1, median, q3"""


_stat("price_box_stats", charts.price_box_stats, _box_sql("cleaned"))
_stat(
    "price_outliers",
    lambda df: charts.price_outliers(df).select("product_url", "platform", "current_price"),
    f"""SELECT product_url, platform, current_price FROM cleaned JOIN ({_quartiles_sql('cleaned')}) b USING (platform)
WHERE current_price<low OR current_price>high""",
)


def _histogram_sql(source: str) -> str:
    bin_ = "CASE WHEN discount_pct>=0 AND discount_pct<100 THEN CAST(floor(discount_pct/5)*5 AS INTEGER) END"
    return f"""SELECT platform, {bin_} AS bin_start, count(*) AS listings FROM {source}
WHERE discount_pct IS NOT NULL GROUP BY ALL"""


_stat("discount_histogram", charts.discount_histogram, _histogram_sql("cleaned"))
_stat(
    "brand_platform_matrix",
    charts.brand_platform_matrix,
    f"""SELECT brand, platform, count(c.product_url) AS listings, product_count AS brand_total
FROM ({_TOP_BRANDS.format(source='cleaned', n=10)}) t CROSS JOIN (SELECT DISTINCT platform FROM cleaned WHERE brand IN
  (SELECT brand FROM ({_TOP_BRANDS.format(source='cleaned', n=10)}) t2)) p
LEFT JOIN cleaned c USING (brand, platform) GROUP BY brand, platform, product_count""",
)


def _bubble_sql(source: str) -> str:
    return f"""SELECT *, max(product_count) OVER ()*2.0::DOUBLE/1600 AS size_ref FROM (
  SELECT brand, {r2(mean('current_price'))} AS avg_price, {r2(mean('discount_pct'))} AS avg_discount,
    count(*) AS product_count FROM {source}
  WHERE brand IS NOT NULL AND current_price IS NOT NULL AND discount_pct IS NOT NULL
  GROUP BY brand HAVING count(*)>=3) q"""


_stat("brand_bubble", charts.brand_bubble, _bubble_sql("cleaned"))


def _share_sql(source: str) -> str:
    return f"""SELECT bucket_ord, {label('bucket_ord')} AS price_bucket, product_count,
  {r2('product_count/sum(product_count) OVER ()*100')} AS pct,
  (SELECT count(current_price) FROM {source}) AS priced_total
FROM (SELECT bucket_ord, count(*) AS product_count FROM {_BUCKETS.format(source=source)} GROUP BY bucket_ord) g"""


_stat("bucket_share", charts.bucket_share, _share_sql("cleaned"))
_stat(
    "platform_kpi_long",
    charts.platform_kpi_long,
    " UNION ALL ".join(
        f"""SELECT platform, '{m}' AS metric, coalesce({m}, 0) AS "value" FROM ({OVERVIEW}) o"""
        for m in ("avg_current_price", "avg_discount_pct", "pct_products_with_discount")
    ),
)

# --- browsing view ---------------------------------------------------------------------------

CHOICE = ListingFilter(platforms=["asia", "europe"], price_min=50, price_max=500, min_discount=20)
_CHOICE_SQL = (
    "platform IN ('asia','europe') AND current_price BETWEEN 50 AND 500 AND coalesce(discount_pct,0)>=20"
)
_VIEW = f"{CLEANED}, chosen AS (SELECT * FROM cleaned WHERE {_CHOICE_SQL})"
_DEFAULT_VIEW = f"{CLEANED}, chosen AS (SELECT * FROM cleaned WHERE current_price>=0)"
_KPI = f"""SELECT count(*) AS total_products, {r2(mean('current_price'))} AS avg_price,
  {r2(mean('discount_pct'))} AS avg_discount, {r2('count(discount_pct)/count(*)*100')} AS pct_discounted FROM chosen"""


def _on_view(operator: Callable[[DataFrame], DataFrame], choice: ListingFilter = CHOICE) -> Query:
    return on_cleaned(lambda df: operator(views.filter_listings(df, choice)))


register(
    "filter_options",
    on_cleaned(views.filter_options),
    over(
        CLEANED,
        f"""SELECT 'platform' AS option, CAST(row_number() OVER (ORDER BY platform) AS INTEGER) AS place, platform AS label,
  NULL::DOUBLE AS number FROM (SELECT DISTINCT platform FROM cleaned) p
UNION ALL SELECT 'max_price', 1, NULL, coalesce(nullif(max(current_price), 0), 1000) FROM cleaned
UNION ALL SELECT 'brand', CAST(row_number() OVER (ORDER BY product_count DESC, brand) AS INTEGER), brand, product_count
  FROM ({_TOP_BRANDS.format(source='cleaned', n=20)}) b""",
    ),
)
register(
    "filter_listings",
    _on_view(lambda df: _listing_columns(df)),
    over(_VIEW, f"SELECT {LISTING_COLUMNS} FROM chosen"),
)
register(
    "filter_default",
    _on_view(views.kpi_row, ListingFilter()),
    over(_DEFAULT_VIEW, _KPI),
)
register("kpi_row", _on_view(views.kpi_row), over(_VIEW, _KPI))
register(
    "avg_discount_by_platform",
    _on_view(views.avg_discount_by_platform),
    over(_VIEW, f"SELECT platform, {r2(mean('discount_pct'))} AS avg_discount FROM chosen GROUP BY platform"),
)
register(
    "filtered_top_brands",
    on_cleaned(lambda df: views.filtered_top_brands(df, CHOICE)),
    over(_VIEW, _TOP_BRANDS.format(source="chosen", n=10)),
)
register(
    "filtered_bubble",
    on_cleaned(lambda df: views.filtered_bubble(df, CHOICE)),
    over(_VIEW, _bubble_sql("chosen")),
)
register(
    "filtered_buckets",
    on_cleaned(lambda df: views.filtered_buckets(df, CHOICE)),
    over(_VIEW, _share_sql("chosen")),
)
register(
    "filtered_histogram",
    on_cleaned(lambda df: views.filtered_histogram(df, CHOICE)),
    over(_VIEW, _histogram_sql("chosen")),
)
register(
    "filtered_box",
    on_cleaned(lambda df: views.filtered_box(df, CHOICE)),
    over(_VIEW, _box_sql("chosen")),
)


def _hazen_sql(source: str) -> str:
    def quantile(p: float) -> str:
        at = f"least(greatest({p}*n-0.5, 0), n-1)"
        low, high = (f"v[CAST({f}({at}) AS BIGINT)+1]" for f in ("floor", "ceil"))
        return r6(f"({low}+({at}-floor({at}))*({high}-{low}))")

    q = {name: quantile(p) for name, p in charts.QUARTILES.items()}
    return f"""SELECT platform, q1, median, q3, {r6('q1-(q3-q1)*1.5')} AS low, {r6('q3+(q3-q1)*1.5')} AS high FROM (
  SELECT platform, {q['q1']} AS q1, {q['median']} AS median, {q['q3']} AS q3 FROM (
    SELECT platform, list(current_price ORDER BY current_price) AS v, count(*) AS n FROM {source}
    WHERE current_price IS NOT NULL GROUP BY platform) s) q"""


register(
    "filtered_box_hazen",
    on_cleaned(lambda df: views.filtered_box(df, CHOICE, method="hazen")),
    over(_VIEW, _box_sql("chosen", _hazen_sql)),
)

# --- approximate quantiles -------------------------------------------------------------------

_PROBS = {"q1": 0.25, "median": 0.5, "p99": 0.99}


def approx_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles from the merged sketches of four parts of the table: per platform the prices counted, and whether the rank of
    every answer is within the stated error."""
    base = fx.base_listings(spark, sf)
    run = F.pmod(F.xxhash64("product_url"), F.lit(4))
    parts = sketches.sketches(base.withColumn("run", run), ["platform", "run"], "current_price")
    whole = sketches.merged(parts, ["platform"])
    asked = sketches.quantiles_of_sketches(whole, ["platform"], _PROBS).join(whole.select("platform", "n"), "platform")
    price = F.col("current_price")
    counts = [F.count_if(f(price, F.col(name))).alias(f"{side}_{name}") for name in _PROBS for side, f in (("below", lambda a, b: a < b), ("upto", lambda a, b: a <= b))]
    met = attach_groups(base.where(price.isNotNull()), asked, ["platform"], "inner").groupBy("platform", "n").agg(*counts)
    error = F.lit(sketches.RANK_ERROR) * F.col("n") + 1
    within = [(F.col(f"below_{name}") <= p * F.col("n") + error) & (F.col(f"upto_{name}") >= p * F.col("n") - error) for name, p in _PROBS.items()]
    return met.select("platform", "n", *[w.alias(f"{name}_within") for name, w in zip(_PROBS, within, strict=True)])


register(
    "approx_prices",
    approx_prices,
    over(
        LISTINGS,
        """SELECT platform, count(current_price) AS n, true AS q1_within, true AS median_within, true AS p99_within
FROM listings WHERE current_price IS NOT NULL GROUP BY platform""",
    ),
)

# --- empty input -----------------------------------------------------------------------------

_NOTHING = ListingFilter(price_min=1e12)
_EMPTY_VIEW = f"{CLEANED}, chosen AS (SELECT * FROM cleaned WHERE current_price>=1e12)"
_EMPTY: dict[str, tuple[Callable[[DataFrame], DataFrame], str]] = {
    "kpi_row": (views.kpi_row, _KPI.replace("/count(*)*100", "/nullif(count(*), 0)*100")),
    "avg_discount_by_platform": (views.avg_discount_by_platform, f"SELECT platform, {r2(mean('discount_pct'))} AS d FROM chosen GROUP BY platform"),
    "top_brands": (stats.top_brands_count, _TOP_BRANDS.format(source="chosen", n=10)),
    "bubble": (charts.brand_bubble, _bubble_sql("chosen")),
    "buckets": (charts.bucket_share, _share_sql("chosen")),
    "histogram": (charts.discount_histogram, _histogram_sql("chosen")),
    "box": (charts.price_box_stats, _box_sql("chosen")),
    "extremes": (stats.price_extremes, "SELECT platform FROM chosen WHERE current_price IS NOT NULL GROUP BY platform"),
    "outliers": (charts.price_outliers, "SELECT * FROM chosen"),
    "deals": (deals.genuine_deals, "SELECT * FROM chosen"),
    "overview": (stats.platform_overview, "SELECT platform FROM chosen GROUP BY platform"),
    "distribution": (stats.discount_distribution, "SELECT count(*) FROM chosen"),
    "over50": (stats.over50_by_platform, "SELECT platform FROM chosen GROUP BY platform"),
    "cleaned": (clean.clean, "SELECT * FROM chosen"),
}


def empty_view(spark: SparkSession, sf: str) -> DataFrame:
    """Every statistic over a view without listings: its number of rows, and the first as JSON."""
    nothing = views.filter_listings(fx.cleaned_listings(spark, sf), _NOTHING)
    parts = []
    for name, (operator, _) in _EMPTY.items():
        found = operator(nothing)
        row = F.to_json(F.struct(*found.columns), {"ignoreNullFields": "false"}) if name == "kpi_row" else F.lit(None).cast("string")
        parts.append(found.select(row.alias("row")).agg(F.count(F.lit(1)).alias("rows"), F.max("row").alias("row")).withColumn("statistic", F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b), parts)


register(
    "empty_view",
    empty_view,
    over(
        _EMPTY_VIEW,
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS statistic, count(*) AS rows, "
            + ("CAST(max(to_json(q)) AS VARCHAR)" if name == "kpi_row" else "NULL::VARCHAR")
            + f" AS row FROM ({sql}) q"
            for name, (_, sql) in _EMPTY.items()
        ),
    ),
)
_TERM = " Anvil"
_MATCH = "(contains(lower(product_name), 'anvil') OR coalesce(contains(lower(brand), 'anvil'), false))"
register(
    "search_listings",
    _on_view(lambda df: views.display_columns(views.search_listings(df, _TERM))),
    over(
        _VIEW,
        f"""SELECT platform, brand, product_name, current_price, original_price, discount_pct, rating, review_count,
  category, scraped_at FROM chosen WHERE {_MATCH}""",
    ),
)
register(
    "search_regex",
    _on_view(
        lambda df: views.search_listings(df, r"^(old|new) |#1\d$", regex=True).select(
            "product_url", "product_name", "brand"
        )
    ),
    over(
        _VIEW,
        """SELECT product_url, product_name, brand FROM chosen
WHERE regexp_matches(lower(product_name), '^(old|new) |#1\\d$') OR regexp_matches(lower(brand), '^(old|new) |#1\\d$')""",
    ),
)
register(
    "search_counts",
    _on_view(lambda df: views.search_counts(df, _TERM)),
    over(_VIEW, f"SELECT count(*) FILTER ({_MATCH}) AS shown, count(*) AS total FROM chosen"),
)

# --- pages, files, streams -------------------------------------------------------------------

register(
    "extract_cards",
    lambda spark, sf: _listing_columns(extract.listings_of_cards(pages.page_cards(spark, sf))),
    pages.EXPECTED,
)
register(
    "extraction_summary",
    lambda spark, sf: extract.extraction_summary(pages.page_cards(spark, sf)),
    pages.EXPECTED_SUMMARY,
)
register(
    "extraction_errors",
    lambda spark, sf: extract.extract(pages.captured_pages(spark, sf)).errors,
    pages.EXPECTED_ERRORS,
)


def raw_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Two drops with different header orders, one with an extra column, written and read back."""
    folder = new_path(spark, "drops")
    listings = fx.text_listings(spark, sf)
    early = F.col("scraped_at") < _LOADED_BEFORE
    write_raw_csv(listings.where(early), folder, "run-0")
    late = listings.where(~early).withColumn("extra", F.lit('a "b", c'))
    write_raw_csv(late, folder, "run-1", ["extra", *RAW_COLUMNS[::-1]])
    return load.coerce_types(read_raw_csv(spark, folder)).select(*RAW_COLUMNS)


_CENTS = "CAST(CAST({0} AS DECIMAL(12,2)) AS DOUBLE) AS {0}"
register(
    "raw_csv_roundtrip",
    raw_csv_roundtrip,
    over(
        raw(True),
        f"""SELECT platform, product_name, brand, {_CENTS.format('current_price')}, {_CENTS.format('original_price')},
  {_CENTS.format('discount_pct')}, {_CENTS.format('rating')}, CAST(review_count AS BIGINT) AS review_count,
  product_url, scraped_at, category FROM raw""",
    ),
)

RUNS = 4
_RUN_SQL = "CASE WHEN scraped_at='not a date' THEN 0 ELSE (CAST(substr(scraped_at, 6, 2) AS INTEGER)-1)//3 END"


def _loaded(spark: SparkSession, sf: str, files_per_load: int = FILES_PER_LOAD) -> str:
    """Table of the fixture loaded in four drops, one per quarter of the capture time; the stream runs after each.

    The names of the drops fall, so that a load that ordered rows by name across loads would be found out.
    """
    folder, table = new_path(spark, "landing"), new_path(spark, "loaded")
    sold = fx.sold_by_run(spark, sf, lambda at: F.coalesce(F.quarter(F.try_to_date(at)) - 1, F.lit(0)))
    for run in range(RUNS):
        write_raw_csv(fx.sorted_run(sold, run), folder, f"run-{RUNS - run}")
        load_drops(
            spark, folder, table, f"{table}-checkpoint", f"{table}-quarantine", files_per_load
        ).awaitTermination()
    return table


def incremental_load(spark: SparkSession, sf: str) -> DataFrame:
    return read_loaded(spark, _loaded(spark, sf)).select(*RAW_COLUMNS)


def loaded_extremes(spark: SparkSession, sf: str) -> DataFrame:
    """Ties over several loads: of equally cheap or dear listings the one that was loaded first is named."""
    return stats.price_extremes(read_loaded(spark, _loaded(spark, sf, 3)))


def loader_summary(spark: SparkSession, sf: str) -> DataFrame:
    """What the loads say of themselves, added up over the loads."""
    totals = read_summary(spark, _loaded(spark, sf)).groupBy("platform")
    return totals.agg(*[F.sum(c).alias(c) for c in ("offered", "inserted", "skipped")])


_LOADED_SQL = f"""(SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY product_url ORDER BY {_RUN_SQL}, {KEY}) AS rn FROM raw
  WHERE scraped_at<>'not a date') q WHERE rn=1 OR product_url IS NULL)"""
_DECIMAL = "CAST({0} AS DECIMAL({1})) AS {0}"
register(
    "incremental_load",
    incremental_load,
    over(
        raw(True),
        f"""SELECT platform, product_name, brand, {_DECIMAL.format('current_price', '10,2')},
  {_DECIMAL.format('original_price', '10,2')}, {_DECIMAL.format('discount_pct', '5,2')}, {_DECIMAL.format('rating', '3,2')},
  review_count, product_url, CAST(scraped_at AS TIMESTAMP) AS scraped_at, category FROM {_LOADED_SQL}""",
    ),
)
_FIRST_AT = "row_number() OVER (PARTITION BY platform ORDER BY {0}, " + f"{_RUN_SQL}, {KEY}) AS r"
_LOADED_PRICES = f"(SELECT * REPLACE (CAST(current_price AS DECIMAL(10,2)) AS current_price) FROM {_LOADED_SQL}) WHERE current_price IS NOT NULL"
register(
    "loaded_extremes",
    loaded_extremes,
    over(
        raw(True),
        f"""SELECT lo.platform, lo.product_name AS cheapest_name, lo.brand AS cheapest_brand, lo.current_price AS cheapest_price,
  hi.product_name AS dearest_name, hi.brand AS dearest_brand, hi.current_price AS dearest_price
FROM (SELECT *, {_FIRST_AT.format('current_price')} FROM {_LOADED_PRICES}) lo
JOIN (SELECT *, {_FIRST_AT.format('current_price DESC')} FROM {_LOADED_PRICES}) hi
  ON lo.platform=hi.platform AND lo.r=1 AND hi.r=1""",
    ),
)
register(
    "loader_summary",
    loader_summary,
    over(
        raw(True),
        f"""SELECT platform, sum(o)::BIGINT AS offered, sum(i)::BIGINT AS inserted, sum(o - i)::BIGINT AS skipped FROM (
  SELECT platform, 1 AS o, 0 AS i FROM raw WHERE scraped_at<>'not a date'
  UNION ALL SELECT platform, 0, 1 FROM {_LOADED_SQL}) q GROUP BY platform""",
    ),
)



def replaced_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned table written, read, and replaced by a part of itself."""
    path = new_path(spark, "cleaned table")
    write_cleaned(fx.cleaned_listings(spark, sf), path)
    write_cleaned(read_listings(spark, path).where("platform != 'asia'"), path)
    return read_listings(spark, path).select(*RAW_COLUMNS)


register("replaced_cleaned", replaced_cleaned, f"SELECT * FROM ({ORACLES['cleaned_listings']}) WHERE platform <> 'asia'")


def export_view(spark: SparkSession, sf: str) -> DataFrame:
    """Filter, search and display columns of the view, written as CSV and read back, row by row."""
    path = new_path(spark, "export")
    view = views.filter_listings(fx.cleaned_listings(spark, sf), ListingFilter(price_max=500.0, min_discount=10))
    write_export(views.display_columns(views.search_listings(view, "a[lr]m", regex=True)), path)
    schema = ", ".join(f"{c} {CLEANED_TYPES[c]}" for c in DISPLAY_COLUMNS)
    return spark.read.csv(path, header=True, escape='"', schema=schema, enforceSchema=False)


register(
    "export_view",
    export_view,
    over(
        CLEANED,
        """SELECT platform, brand, product_name, current_price, original_price, discount_pct, rating, review_count,
  category, scraped_at FROM cleaned
WHERE current_price BETWEEN 0 AND 500 AND discount_pct>=10
  AND (regexp_matches(lower(product_name), 'a[lr]m') OR regexp_matches(lower(brand), 'a[lr]m'))""",
    ),
)


def clustered_view(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned table laid out along a curve over brand, price and more, and a view by brand and price of it."""
    path = new_path(spark, "clustered")
    write_cleaned(fx.cleaned_listings(spark, sf), path, cluster_by=CLUSTER_BY, rows_per_file=2000)
    return _listing_columns(views.filter_table(spark, path, _CLUSTERED_CHOICE))


_CLUSTERED_CHOICE = ListingFilter(price_min=100, price_max=300, brands=["Brand#13", "Brand#31"], min_discount=20)
register(
    "clustered_view",
    clustered_view,
    over(
        CLEANED,
        f"""SELECT {LISTING_COLUMNS} FROM cleaned WHERE current_price BETWEEN 100 AND 300
  AND brand IN ('Brand#13','Brand#31') AND discount_pct>=20""",
    ),
)

GENERATED_AT = "2024-01-01T00:00:00"
register("report_json", on_cleaned(lambda df: report.report_json(df, GENERATED_AT)))


def report_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The saved report document, read back and laid out as rows: section, key, value."""
    path = new_path(spark, "report")
    write_report(fx.cleaned_listings(spark, sf), path, GENERATED_AT)
    saved = read_report(spark, path)

    def rows(section: str, entries: Column, key: Callable, value: Callable) -> DataFrame:
        parts = F.transform(entries, lambda e: F.struct(key(e).alias("key"), value(e).cast("double").alias("value")))
        return saved.select(F.lit(section).alias("section"), F.inline(parts))

    def listing(e: Column) -> Column:
        return F.concat_ws("|", e["platform"], e["brand"], e["product_name"])

    overview, deep = F.map_entries("platform_overview"), F.map_entries("discount_behaviour.over_50pct_per_platform")
    extremes, brands = F.map_entries("price_analysis.extremes_per_platform"), F.col("brand_analysis")
    prices, spread = F.col("price_analysis"), F.col("discount_behaviour.distribution")
    parts = [
        rows("total_rows", F.array("total_rows"), lambda e: F.lit(""), lambda e: e),
        *[
            rows(m, overview, lambda e: e["key"], lambda e, m=m: e["value"][m])
            for m in ("total_products", "avg_current_price", "avg_discount_pct", "pct_products_with_discount")
        ],
        *[rows(m, F.array(spread[m]), lambda e: F.lit(""), lambda e: e) for m in _SPREAD],
        rows("most_discounted", F.col("discount_behaviour.top10_most_discounted"), listing, lambda e: e["discount_pct"]),
        rows("over_50pct", deep, lambda e: e["key"], lambda e: e["value"]),
        *[
            rows(v, brands[name], lambda e: e["brand"], lambda e, v=v: e[v])
            for name, v in (
                ("top10_by_product_count", "product_count"),
                ("top10_by_avg_discount", "avg_discount"),
                ("top10_by_avg_price", "avg_price"),
            )
        ],
        rows("bucket_counts", prices["bucket_counts"], lambda e: e["price_bucket"], lambda e: e["product_count"]),
        rows(
            "bucket_prices",
            prices["avg_price_per_platform_per_bucket"],
            lambda e: F.concat_ws("|", e["platform"], e["price_bucket"]),
            lambda e: e["avg_price"],
        ),
        *[
            rows(
                side,
                extremes,
                lambda e, side=side: F.concat_ws("|", e["key"], e["value"][side]["brand"], e["value"][side]["product_name"]),
                lambda e, side=side: e["value"][side]["current_price"],
            )
            for side in ("cheapest", "most_expensive")
        ],
        rows("key_insights", F.col("key_insights"), lambda e: e, lambda e: F.lit(0)),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


_SPREAD = ("min", "max", "mean", "median", "count_above_50pct")


def _section(name: str, key: str, value: str, twin: str) -> str:
    return f"""SELECT '{name}' AS section, {key} AS "key", CAST({value} AS DOUBLE) AS "value" FROM ({ORACLES[twin]}) q"""


_TITLE = "array_to_string([upper(x[1]) || x[2:] FOR x IN string_split(subject, ' ')], ' ')"
_INSIGHT = f"""CASE insight_no WHEN 1 THEN {_TITLE} || ' discounts deepest: ' || printf('%.1f%%', "value") || ' off on average.'
  WHEN 2 THEN {_TITLE} || ' discounts most often: ' || printf('%.1f%%', "value") || ' of its listings.'
  WHEN 3 THEN printf('%.0f', "value") || ' listings (' || printf('%.1f%%', share) || ') are more than 50% off.'
  WHEN 4 THEN 'Most listings cost ' || subject || ': ' || printf('%.0f', "value") || ' (' || printf('%.1f%%', share) || ').'
  ELSE {_TITLE} || ' is the dearest platform: ' || printf('%.2f', "value") || ' on average.' END"""
register(
    "report_rows",
    report_rows,
    " UNION ALL ".join(
        [
            _section("total_rows", "''", "total_rows", "dataset_header"),
            *[
                _section(m, "platform", m, "platform_overview")
                for m in ("total_products", "avg_current_price", "avg_discount_pct", "pct_products_with_discount")
            ],
            *[_section(m, "''", m, "discount_distribution") for m in _SPREAD],
            _section("most_discounted", "concat_ws('|', platform, brand, product_name)", "discount_pct", "top_discounted"),
            _section("over_50pct", "platform", "listings", "over50_by_platform"),
            _section("product_count", "brand", "product_count", "top_brands_count"),
            _section("avg_discount", "brand", "avg_discount", "top_brands_discount"),
            _section("avg_price", "brand", "avg_price", "top_brands_price"),
            _section("bucket_counts", "price_bucket", "product_count", "bucket_counts"),
            _section("bucket_prices", "concat_ws('|', platform, price_bucket)", "avg_price", "bucket_avg_price"),
            _section("cheapest", "concat_ws('|', platform, cheapest_brand, cheapest_name)", "cheapest_price", "price_extremes"),
            _section("most_expensive", "concat_ws('|', platform, dearest_brand, dearest_name)", "dearest_price", "price_extremes"),
            _section("key_insights", _INSIGHT, "0", "key_insights"),
        ]
    ),
)


def saved_report_kpi(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "report")
    write_report(fx.cleaned_listings(spark, sf), path)
    return report.kpi_of_report(read_report(spark, path))


register("saved_report_kpi", saved_report_kpi, ORACLES["platform_kpi_long"])
