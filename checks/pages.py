"""Captured pages rendered from the listing fixture, one listing and one nameless card per page.

Line numbers choose the layout; key remainders choose card containers, price ranges, missing links
and unclosed tags. The driver's ``pages`` table adds pages without any card.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixture as fx
from checks.sql import raw
from shelfprice.operators.extract import card_texts
from shelfprice.schema import ORDER_KEY

PLATFORMS = {"L": "Lanes", "S": "Shelf", "Z": "zoom"}
SITE = "https://site.example"
_TIME = "0 10:20:30.456"


def _text(*parts: Column | str) -> Column:
    """Concatenation that is empty as soon as one part is missing."""
    return F.coalesce(F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts]), F.lit(""))


def _card(layout: str, key: Column, item: Column) -> Column:
    price, original = (F.format_number(c, 2) for c in ("current_price", "original_price"))
    shown = F.when(key % 11 == 0, F.concat(price, F.lit(" - RM9,999.00"))).otherwise(price)
    discount = F.col("discount_pct").cast("decimal(5,1)").cast("string")
    rating = F.col("rating").cast("decimal(3,1)").cast("string")
    reviews = F.col("review_count").cast("string")
    name = F.concat("product_name", F.lit(" &amp; &lt;co&gt;"))
    linked = key % 13 != 0
    if layout == "L":
        href = F.when(linked, F.concat(F.lit(' href="//shop.example/'), item, F.lit('"'))).otherwise("")
        box = F.when(key % 3 == 0, '<div class="x" data-qa-locator="product-item">').when(
            key % 3 == 1, '<div data-item-id="7">'
        )
        return F.concat(
            F.coalesce(box, F.lit("<div class='grid Bm3ON'>")),
            _text("<p>ad<div class='RfADt'><a", href, "> ", name, " </a></div>"),
            _text("<div class=line-clamp-1><a>", F.col("brand"), "</a></div>"),
            _text("<span class='aBrP0'>RM", shown, "</span>"),
            _text("<s>RM", original, "</s>"),
            _text("<span class='IcOsH'>", discount, "% Off</span>"),
            _text("<span class='bjBOp'>", rating, "/5</span>"),
            _text("<span class='qzqFl'>(", reviews, ")</span>"),
            F.lit("</div>"),
            F.coalesce(box, F.lit("<div class='grid Bm3ON'>")),
            F.lit("<b>no name</b></div>"),
        )
    if layout == "S":
        box = F.when(key % 3 == 0, "<li class='col shopee-search-item-result__item'>").when(
            key % 3 == 1, "<div class='col-xs-2-4'>"
        )
        box = F.coalesce(box, F.lit("<div data-sqe='item'>"))
        href = F.when(key % 2 == 0, F.concat(F.lit("/product/"), item)).otherwise(F.concat(F.lit("deals/"), item))
        priced = F.when(key % 2 == 0, _text("<span class=_341bF9>RM", shown, "</span>"))
        in_box = _text("<div class='price-box'><span>RM", shown, "</span><span>each</span></div>")
        return F.concat(
            box,
            F.when(linked, _text("<a href='", href, "'></a><a href='/later'>")).otherwise(""),
            _text("<div data-sqe='name'>", name, "</div>"),
            _text("<div class=item-brand>", F.col("brand"), "</div>"),
            F.coalesce(priced, in_box),
            _text("<s>RM", original, "</s>"),
            _text("<span class='discount-tag'>-", discount, "%</span>"),
            _text("<div class='rating-box'><span>", rating, "</span></div>"),
            _text("<span class=sold>", reviews, ".5k sold</span>"),
            # The list items stay open: the next item ends them.
            F.when(key % 3 == 0, "").otherwise("</a></div>"),
            box,
            F.lit("<a href='/none'>no name</a>"),
        )
    href = F.when(linked, F.concat(F.lit(" href='/p/"), item, F.lit("'"))).otherwise("")
    reduced = price.isNotNull() & original.isNotNull()
    return F.concat(
        _text("<a data-test-id='productLink'", href, ">"),
        _text("<div data-test-id='productBrandName'>", F.col("brand"), "</div>"),
        _text("<div data-test-id=productTitle>", name, "</div>"),
        F.when(
            reduced,
            _text(
                "<i data-test-id='originalPrice'>RM", original, "</i><i data-test-id='specialPrice'>RM&nbsp;", shown, "</i>"
            ),
        ).otherwise(_text("<i data-test-id='originalPrice'>From RM", shown, "</i>")),
        _text("<em data-test-id='discountPercentage'>-", discount, "%</em>"),
        _text("<div data-test-id='rating'>", rating, "</div>"),
        F.when(key % 17 != 0, "</a>").otherwise("<br>"),
        F.lit("<a data-test-id='productLink' href='/x'><div>no name</div></a>"),
    )


def rendered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The test table is one file with one row group: spread its rows before the texts are built.
    df = fx.raw_listings(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism)
    key, line = F.col(f"{ORDER_KEY}.l_partkey"), F.col(f"{ORDER_KEY}.l_linenumber")
    item = F.concat(key, F.lit("-"), F.col(f"{ORDER_KEY}.l_suppkey"))
    layout = F.element_at(F.array(F.lit("Z"), F.lit("L"), F.lit("S")), line % 3 + 1)
    cards = F.when(layout == "L", _card("L", key, item)).when(layout == "S", _card("S", key, item))
    body = F.coalesce(cards, _card("Z", key, item))
    shipped = F.to_timestamp_ntz(F.regexp_replace("scraped_at", "not a date", "2001-02-03T00:00:00"))
    return df.select(
        (F.col(f"{ORDER_KEY}.l_orderkey") * 8 + line).alias("page_id"),
        layout.alias("layout"),
        F.element_at(F.create_map(*[F.lit(x) for pair in PLATFORMS.items() for x in pair]), layout).alias("platform"),
        (shipped + F.expr(f"INTERVAL '{_TIME}' DAY TO SECOND")).alias("captured_at"),
        F.concat(F.lit(f"{SITE}/list?page="), F.col(f"{ORDER_KEY}.l_orderkey")).alias("url"),
        F.concat(
            F.lit("<!DOCTYPE html><html><head><style>.x{}</style><script>if(1<2)'</a>';</script></head><body>"),
            body,
            F.lit("</body></html>"),
        ).alias("html"),
    )


def captured_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table of captured pages, written once per application."""
    return fx.written_once(spark, sf_dir, "captured_pages", lambda: _all_pages(spark, sf_dir), [])


def page_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards of the captured pages, read once per application."""
    return fx.written_once(spark, sf_dir, "page_cards", lambda: card_texts(captured_pages(spark, sf_dir)), [])


def _all_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cardless = fx.table(spark, sf_dir, "pages").select(
        "page_id",
        # Some come from a site whose layout nobody has described.
        F.when(F.col("page_id") % 5 == 0, F.lit("Q")).otherwise(F.lit("Z")).alias("layout"),
        F.lit(PLATFORMS["Z"]).alias("platform"),
        F.lit("2001-02-03 04:05:06").cast("timestamp_ntz").alias("captured_at"),
        "url",
        "html",
    )
    return rendered_pages(spark, sf_dir).unionByName(cardless)


_ITEM = "l_partkey||'-'||l_suppkey"
EXPECTED = f"""WITH {raw()}, t AS (SELECT *, CASE l_linenumber%3 WHEN 1 THEN 'L' WHEN 2 THEN 'S' ELSE 'Z' END AS layout,
  CAST(CAST(discount_pct AS DECIMAL(5,1)) AS DOUBLE) AS d, CAST(CAST(rating AS DECIMAL(3,1)) AS DOUBLE) AS r FROM raw)
SELECT CASE layout WHEN 'L' THEN '{PLATFORMS['L']}' WHEN 'S' THEN '{PLATFORMS['S']}' ELSE '{PLATFORMS['Z']}' END AS platform,
  product_name || ' & <co>' AS product_name, brand,
  CASE WHEN layout='L' AND l_partkey%11=0 THEN NULL ELSE current_price END AS current_price,
  CASE WHEN layout<>'Z' OR current_price IS NOT NULL THEN original_price END AS original_price,
  d AS discount_pct, r AS rating,
  CASE layout WHEN 'L' THEN CAST(review_count AS BIGINT) WHEN 'S' THEN CAST(review_count AS BIGINT)*1000+500 END AS review_count,
  CASE layout WHEN 'L' THEN CASE WHEN l_partkey%13=0 THEN '' ELSE 'https://shop.example/'||{_ITEM} END
    WHEN 'S' THEN CASE WHEN l_partkey%13=0 THEN '{SITE}/' WHEN l_partkey%2=0 THEN '{SITE}/product/'||{_ITEM} ELSE '{SITE}/deals/'||{_ITEM} END
    ELSE CASE WHEN l_partkey%13=0 THEN '{SITE}/' ELSE '{SITE}/p/'||{_ITEM} END END AS product_url,
  strftime((CASE WHEN l_orderkey%53=0 THEN TIMESTAMP '2001-02-03' ELSE l_shipdate END) + INTERVAL '10:20:30.456',
    '%Y-%m-%dT%H:%M:%S') AS scraped_at, 'fashion' AS category FROM t"""

EXPECTED_SUMMARY = """WITH t AS (SELECT CASE l_linenumber%3 WHEN 1 THEN 'L' WHEN 2 THEN 'S' ELSE 'Z' END AS layout,
  l_partkey FROM lineitem)
SELECT layout, 2*count(*) AS cards, count(*) AS listings, count(*) AS nameless_cards,
  count(*) FILTER (l_partkey%13=0) AS linkless_listings, 0::BIGINT AS unreadable_cards, 0::BIGINT AS unreadable_pages,
  CASE WHEN layout='Z' THEN (SELECT count(*) FROM pages WHERE page_id%5<>0) ELSE 0 END AS empty_pages
FROM t GROUP BY layout
UNION ALL SELECT 'Q', 0, 0, 0, 0, 0, count(*), 0 FROM pages WHERE page_id%5=0 HAVING count(*)>0"""

EXPECTED_ERRORS = "SELECT page_id, 'Q' AS layout, url, NULL::INTEGER AS card_no, 'page: unknown layout' AS error FROM pages WHERE page_id%5=0"
