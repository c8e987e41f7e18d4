"""From captured pages to raw listing records.

One Python pass per page finds the cards and takes their texts, driven by the layout rules. Turning
text into numbers and URLs is native. Pages are independent rows, so nothing is shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfprice.functions import markup
from shelfprice.functions.markup import Matches, Plan, read_page, selector_chains
from shelfprice.functions.parse import (
    absolutise_url,
    assign_prices,
    parse_count,
    parse_discount,
    parse_price,
    parse_rating,
    site_root,
)
from shelfprice.functions.text import iso_seconds
from shelfprice.plans.staging import stage
from shelfprice.schema import ORDER_KEY
from shelfprice.sources.layouts import FIELDS, LAYOUTS

CATEGORY = "fashion"
PAGE_COLUMNS = ["page_id", "layout", "platform", "captured_at", "url"]
_ROWS_PER_BATCH = 512


def _card_texts(page: Matches, card, rules: dict) -> dict:
    texts = {}
    for field in FIELDS:
        tiers = rules.get(field)
        if tiers:
            element = page.first(tiers, card)
            if element is not None:
                texts[field] = element.attrs.get("href", "") if field == "link" else element.text()
        elif field == "link" and tiers is None:
            texts[field] = card.attrs.get("href", "")
    return texts


def _page_cards(html: str, rules: dict, known: dict | None = None, plan: Plan | None = None) -> list[dict]:
    """One entry per card; a card or page that cannot be read gives an entry with ``error``."""
    try:
        matches = Matches(read_page(html or "", known), plan)
        cards = matches.all(rules["cards"])
    except Exception as error:
        return [{"error": f"page: {error}"}]
    found = []
    for number, card in enumerate(cards):
        try:
            found.append({"card_no": number, **_card_texts(matches, card, rules)})
        except Exception as error:
            found.append({"card_no": number, "error": f"card: {error}"})
    return found or [{}]


def _compiled(layouts: dict) -> dict:
    """Layouts with every selector group taken apart once, on the driver; fields of one group share it."""
    compiled = {}
    for name, rules in layouts.items():
        chains = {group: selector_chains(group) for tiers in rules.values() if isinstance(tiers, list) for group in tiers}
        compiled[name] = {
            field: [chains[group] for group in tiers] if isinstance(tiers, list) else tiers for field, tiers in rules.items()
        }
    return compiled


def _plan(rules: dict) -> Plan:
    groups = {id(group): group for tiers in rules.values() if isinstance(tiers, list) for group in tiers}
    return Plan(list(groups.values()))


def _card_reader(layouts: dict, arrow_schema: pa.Schema) -> Callable:
    columns_of = [(f.name, f.type, f.name in PAGE_COLUMNS) for f in arrow_schema]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Tags that were read, and what to look for, by layout.
        ready = {layout: (rules, {}, _plan(rules)) for layout, rules in layouts.items()}
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS_PER_BATCH):
                pages = batch.slice(start, _ROWS_PER_BATCH)
                cards, places = [], []
                for place, (layout, html) in enumerate(zip(*[pages[c].to_numpy(zero_copy_only=False).tolist() for c in ("layout", "html")], strict=True)):
                    known = ready.get(layout)
                    found = _page_cards(html, *known) if known else [{"error": "page: unknown layout"}]
                    cards.extend(found)
                    places.extend([place] * len(found))
                taken = pa.array(places, pa.int32())
                columns = [
                    pages[name].take(taken).cast(type_) if of_page else pa.array([c.get(name) for c in cards], type_)
                    for name, type_, of_page in columns_of
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow_schema)

    return read


def _card_schema() -> tuple[T.StructType, pa.Schema]:
    spark_types = [
        ("page_id", T.LongType(), pa.int64()),
        ("layout", T.StringType(), pa.string()),
        ("platform", T.StringType(), pa.string()),
        ("captured_at", T.TimestampNTZType(), pa.timestamp("us")),
        ("url", T.StringType(), pa.string()),
        ("card_no", T.IntegerType(), pa.int32()),
        *[(field, T.StringType(), pa.string()) for field in FIELDS],
        ("error", T.StringType(), pa.string()),
    ]
    return (
        T.StructType([T.StructField(name, type_) for name, type_, _ in spark_types]),
        pa.schema([(name, type_) for name, _, type_ in spark_types]),
    )


def card_texts(pages: DataFrame, layouts: dict = LAYOUTS) -> DataFrame:
    """One row per card with its raw texts, plus one row without ``card_no`` per page without cards."""
    # The reader travels with the job, so workers need no installed copy of this package.
    for module in (markup, sys.modules[__name__]):
        cloudpickle.register_pickle_by_value(module)
    schema, arrow_schema = _card_schema()
    reader = _card_reader(_compiled(layouts), arrow_schema)
    return pages.select(*PAGE_COLUMNS, "html").mapInArrow(reader, schema)


def _rule(layouts: dict, holds: Callable[[dict], bool]) -> Column:
    return F.coalesce(F.col("layout").isin([k for k, rules in layouts.items() if holds(rules)]), F.lit(False))


def listings_of_cards(cards: DataFrame, layouts: dict = LAYOUTS, category: str = CATEGORY) -> DataFrame:
    """Cards with a product name as raw listing records, in (page, card) order."""
    cut = _rule(layouts, lambda r: r["cut_range"])
    keep_unrooted = _rule(layouts, lambda r: r["keep_unrooted"])
    two_prices = _rule(layouts, lambda r: "sale" in r)
    # The texts are assigned and then parsed, each price once: code for all four would be too long to be compiled well.
    current, original = assign_prices(F.col("sale"), F.col("regular"))
    return cards.where(F.length("name") > 0).select(
        "platform",
        F.col("name").alias("product_name"),
        "brand",
        parse_price(F.when(two_prices, current).otherwise(F.col("price")), cut).alias("current_price"),
        parse_price(F.when(two_prices, original).otherwise(F.col("original")), cut).alias("original_price"),
        parse_discount(F.col("discount")).alias("discount_pct"),
        parse_rating(F.col("rating")).alias("rating"),
        parse_count(F.col("reviews")).alias("review_count"),
        absolutise_url(F.col("link"), site_root(F.col("url")), keep_unrooted).alias("product_url"),
        iso_seconds(F.col("captured_at")).alias("scraped_at"),
        F.lit(category).alias("category"),
        F.struct("page_id", "card_no").alias(ORDER_KEY),
    )


def extract_listings(pages: DataFrame, layouts: dict = LAYOUTS, category: str = CATEGORY) -> DataFrame:
    return listings_of_cards(card_texts(pages, layouts), layouts, category)


def extraction_errors(cards: DataFrame) -> DataFrame:
    """Cards and pages that could not be read, and why; ``card_no`` is NULL for a whole page."""
    return cards.where(F.col("error").isNotNull()).select("page_id", "layout", "url", "card_no", "error")


@dataclass(frozen=True)
class Extraction:
    """What one reading of the pages gave."""

    listings: DataFrame
    errors: DataFrame
    summary: DataFrame


def extract(pages: DataFrame, layouts: dict = LAYOUTS, category: str = CATEGORY) -> Extraction:
    """Listings, errors and counts from a single parse of the pages, whose cards are staged."""
    cards = stage(card_texts(pages, layouts), "cards")
    return Extraction(listings_of_cards(cards, layouts, category), extraction_errors(cards), extraction_summary(cards))


def extraction_summary(cards: DataFrame) -> DataFrame:
    """Per layout: cards, listings, cards without name or link, unreadable cards and pages, empty pages."""
    is_card = F.col("card_no").isNotNull()
    read = is_card & F.col("error").isNull()
    named = F.coalesce(F.length("name") > 0, F.lit(False))
    linked = F.coalesce(F.length("link") > 0, F.lit(False))
    return cards.groupBy("layout").agg(
        F.count_if(is_card).alias("cards"),
        F.count_if(read & named).alias("listings"),
        F.count_if(read & ~named).alias("nameless_cards"),
        F.count_if(read & named & ~linked).alias("linkless_listings"),
        F.count_if(is_card & F.col("error").isNotNull()).alias("unreadable_cards"),
        F.count_if(~is_card & F.col("error").isNotNull()).alias("unreadable_pages"),
        F.count_if(~is_card & F.col("error").isNull()).alias("empty_pages"),
    )
