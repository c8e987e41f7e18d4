"""SQL building blocks of the query twins (DuckDB dialect, over the star-schema views)."""

from __future__ import annotations

KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def r2(x: str) -> str:
    return f"(round_even(({x})*100, 0)/100)"


def r6(x: str) -> str:
    return f"(round_even(({x})*1000000, 0)/1000000)"


def mean(x: str) -> str:
    """Mean from exact whole and fractional sums, so that no summation order shows."""
    whole = f"CAST(sum(CAST(floor({x}) AS BIGINT)) AS DOUBLE)"
    part = f"CAST(sum(CAST(round_even(({x}-floor({x}))*1000000, 0) AS BIGINT)) AS DOUBLE)"
    return f"(({whole}+{part}/1000000)/count({x}))"


UNIT = "l_extendedprice/l_quantity/20"


def raw(missing_urls: bool = False, name: str = "raw") -> str:
    url = "'https://shop.example/' || l_partkey || '-' || l_suppkey"
    if missing_urls:
        url = f"CASE WHEN l_orderkey%101<>0 THEN {url} END"
    return f"""{name} AS (
  SELECT CASE WHEN l_linestatus='O' THEN ' ' || r_name || ' ' ELSE lower(r_name) END AS platform,
    CASE WHEN l_partkey%97=0 THEN CAST(l_partkey AS VARCHAR) WHEN l_partkey%89=0 THEN 'x' ELSE p_name END AS product_name,
    CASE WHEN l_partkey%10<>0 THEN p_brand END AS brand,
    CASE WHEN NOT (l_suppkey%25=0 AND l_linenumber=1) THEN {r2(UNIT)} END AS current_price,
    CASE WHEN l_linenumber%2<>0 THEN {r2(UNIT + '*(1+l_tax*5)')} END AS original_price,
    CASE WHEN l_linenumber%3<>0 THEN {r2('l_discount*800')} END AS discount_pct,
    CASE WHEN l_linenumber<>7 THEN 1+l_tax*50 END AS rating,
    CASE WHEN l_quantity<=45 THEN CAST(l_quantity AS INTEGER) END AS review_count,
    {url} AS product_url,
    CASE WHEN l_orderkey%53=0 THEN 'not a date' ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') END AS scraped_at,
    p_type AS category, {KEY}, l_quantity, l_tax, l_discount, l_returnflag, l_shipdate
  FROM lineitem JOIN part ON l_partkey=p_partkey JOIN supplier ON l_suppkey=s_suppkey
    JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey)"""


def first_wins(source: str = "raw", name: str = "listings") -> str:
    return f"""{name} AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY product_url ORDER BY {KEY}) AS rn FROM {source}) q
  WHERE rn=1 OR product_url IS NULL)"""


P99 = r6("quantile_cont(current_price, 0.99)")

STEP_1 = """c1 AS (SELECT * REPLACE (trim(lower(platform)) AS platform), platform<>lower(platform) AS hit_platform FROM listings)"""
STEP_2 = """c2 AS (SELECT * REPLACE (CASE WHEN brand IS NULL AND product_name IS NOT NULL
    THEN upper(left(split_part(product_name,' ',1),1)) || lower(substr(split_part(product_name,' ',1),2)) ELSE brand END AS brand),
    brand IS NULL AND product_name IS NOT NULL AS hit_brand FROM c1)"""
STEP_3 = f"""caps AS (SELECT platform, {P99} AS p99 FROM c2 GROUP BY platform),
c3 AS (SELECT c2.* REPLACE (CASE WHEN current_price>p99 THEN p99 ELSE current_price END AS current_price),
    coalesce(current_price>p99, false) AS hit_cap FROM c2 JOIN caps USING (platform))"""
_DISCOUNT_MASK = (
    "discount_pct IS NULL AND current_price IS NOT NULL AND original_price>0 AND original_price>current_price"
)
STEP_4 = f"""c4 AS (SELECT * REPLACE (CASE WHEN {_DISCOUNT_MASK}
    THEN {r2('(original_price-current_price)/original_price*100')} ELSE discount_pct END AS discount_pct),
    coalesce({_DISCOUNT_MASK}, false) AS hit_discount FROM c3)"""
_ORIGINAL_MASK = "original_price IS NULL AND current_price IS NOT NULL AND discount_pct>0 AND discount_pct<100"
STEP_5 = f"""c5 AS (SELECT * REPLACE (CASE WHEN {_ORIGINAL_MASK}
    THEN {r2('current_price/(1-discount_pct/100)')} ELSE original_price END AS original_price),
    coalesce({_ORIGINAL_MASK}, false) AS hit_original FROM c4)"""
STEP_6 = """c6 AS (SELECT * REPLACE (TRY_CAST(scraped_at AS TIMESTAMP) AS scraped_at),
    scraped_at IS NOT NULL AND TRY_CAST(scraped_at AS TIMESTAMP) IS NULL AS hit_time FROM c5)"""
JUNK = "(product_name IS NULL OR length(trim(product_name))<=1 OR regexp_full_match(trim(product_name), '[0-9]+'))"
STEP_7 = f"""cleaned AS (SELECT * FROM c6 WHERE NOT {JUNK})"""

LISTINGS = ",\n".join([raw(), first_wins()])
UP_TO = {
    i: ",\n".join([LISTINGS, *steps])
    for i, steps in enumerate(
        [
            [],
            [STEP_1],
            [STEP_1, STEP_2],
            [STEP_1, STEP_2, STEP_3],
            [STEP_1, STEP_2, STEP_3, STEP_4],
            [STEP_1, STEP_2, STEP_3, STEP_4, STEP_5],
            [STEP_1, STEP_2, STEP_3, STEP_4, STEP_5, STEP_6],
            [STEP_1, STEP_2, STEP_3, STEP_4, STEP_5, STEP_6, STEP_7],
        ]
    )
}
CLEANED = UP_TO[7]
LISTING_COLUMNS = (
    "platform, product_name, brand, current_price, original_price, discount_pct, rating, review_count, "
    "product_url, scraped_at, category"
)


def bucket(price: str = "current_price") -> str:
    return (
        f"CASE WHEN {price}>=0 AND {price}<50 THEN 0 WHEN {price}>=50 AND {price}<100 THEN 1 "
        f"WHEN {price}>=100 AND {price}<200 THEN 2 WHEN {price}>=200 AND {price}<500 THEN 3 "
        f"WHEN {price}>=500 AND {price}<'Infinity'::DOUBLE THEN 4 END"
    )


def label(ord_: str) -> str:
    return f"CASE {ord_} WHEN 0 THEN '<50' WHEN 1 THEN '50-100' WHEN 2 THEN '100-200' WHEN 3 THEN '200-500' WHEN 4 THEN '500+' END"


def over(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"
