"""Cleaning steps, in the order in which they must run.

Each step has a mask (the rows it changes, judged on its input) and a change. The cleaned table
applies the changes; the summary additionally counts the masks, in the same pass over the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfprice.functions.numeric import finite_or_null, rint2
from shelfprice.functions.text import first_word_title, is_junk_name, normalise_platform
from shelfprice.plans.joins import attach_groups
from shelfprice.plans.quantiles import exact_quantiles
from shelfprice.schema import RAW_COLUMNS

PRICE_CAP_PROB = 0.99
_CAP = "_price_cap"


def price_caps(listings: DataFrame) -> DataFrame:
    """``platform, p99``: interpolated 0.99 quantile of the prices; platforms without prices absent."""
    return exact_quantiles(listings, ["platform"], "current_price", {"p99": PRICE_CAP_PROB})


def _with_caps(df: DataFrame) -> DataFrame:
    return attach_groups(df, price_caps(df).withColumnRenamed("p99", _CAP), ["platform"])


def _parsed_capture_time() -> Column:
    return F.col("scraped_at").try_cast("timestamp_ntz")


def _current() -> Column:
    return F.col("current_price")


def _original() -> Column:
    return F.col("original_price")


def _discount() -> Column:
    return F.col("discount_pct")


@dataclass(frozen=True)
class Step:
    name: str
    mask: Callable[[], Column]
    column: str | None = None
    value: Callable[[], Column] | None = None
    everywhere: bool = False
    prepare: Callable[[DataFrame], DataFrame] | None = None

    def change(self, df: DataFrame) -> DataFrame:
        if self.column is None:
            return df.where(~self.mask())
        new = self.value()
        if not self.everywhere:
            new = F.when(self.mask(), new).otherwise(F.col(self.column))
        return df.withColumn(self.column, new)


NORMALISE_PLATFORM = Step(
    "normalize_platform",
    lambda: F.col("platform") != F.lower("platform"),
    "platform",
    lambda: normalise_platform(F.col("platform")),
    everywhere=True,
)
FILL_BRAND = Step(
    "fill_brand_from_name",
    lambda: F.col("brand").isNull() & F.col("product_name").isNotNull(),
    "brand",
    lambda: first_word_title(F.col("product_name")),
)
CAP_PRICE = Step(
    "cap_price_outliers",
    lambda: _current() > F.col(_CAP),
    "current_price",
    lambda: F.col(_CAP),
    prepare=_with_caps,
)
# Works on the capped price, so capping enlarges a filled discount.
FILL_DISCOUNT = Step(
    "fill_discount_pct",
    lambda: _discount().isNull() & (_original() > 0) & (_original() > _current()),
    "discount_pct",
    lambda: rint2((_original() - _current()) / _original() * 100),
)
FILL_ORIGINAL = Step(
    "fill_original_price",
    lambda: _original().isNull() & _current().isNotNull() & (_discount() > 0) & (_discount() < 100),
    "original_price",
    lambda: rint2(_current() / (1 - _discount() / 100)),
)
PARSE_CAPTURE_TIME = Step(
    "parse_scraped_at",
    lambda: F.col("scraped_at").isNotNull() & _parsed_capture_time().isNull(),
    "scraped_at",
    _parsed_capture_time,
    everywhere=True,
)
# Last, so that junk rows still take part in the quantiles and counters above.
DROP_JUNK = Step("drop_junk_names", lambda: is_junk_name(F.col("product_name")))

STEPS = [
    NORMALISE_PLATFORM,
    FILL_BRAND,
    CAP_PRICE,
    FILL_DISCOUNT,
    FILL_ORIGINAL,
    PARSE_CAPTURE_TIME,
    DROP_JUNK,
]


def as_doubles(listings: DataFrame) -> DataFrame:
    """Numbers as DOUBLE with NaN folded into NULL, the form all cleaning arithmetic uses."""
    names = ["current_price", "original_price", "discount_pct", "rating"]
    return listings.withColumns({c: finite_or_null(F.col(c).cast("double")) for c in names})


def run_step(df: DataFrame, step: Step) -> DataFrame:
    prepared = step.prepare(df) if step.prepare else df
    return step.change(prepared).drop(_CAP)


def clean(listings: DataFrame, steps: list[Step] = STEPS) -> DataFrame:
    """All steps in order. Reads ``listings`` twice (prices for the caps, then the rows)."""
    df = as_doubles(listings)
    for step in steps:
        df = run_step(df, step)
    return df.select(*RAW_COLUMNS, *[c for c in df.columns if c not in RAW_COLUMNS])


def _counter(step: Step) -> str:
    return f"_hit_{step.name}"


def cleaning_summary(listings: DataFrame) -> DataFrame:
    """One row: rows before, after and dropped, and one counter per step."""
    df = as_doubles(listings)
    for step in STEPS:
        df = step.prepare(df) if step.prepare else df
        df = df.withColumn(_counter(step), F.coalesce(step.mask(), F.lit(False)))
        if step is not DROP_JUNK:
            df = step.change(df)
    dropped = F.count_if(_counter(DROP_JUNK))
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        (F.count(F.lit(1)) - dropped).alias("rows_after"),
        dropped.alias("rows_dropped"),
        *[F.count_if(_counter(s)).alias(s.name) for s in STEPS if s is not DROP_JUNK],
        dropped.alias(DROP_JUNK.name),
    )
