"""From raw text rows to the base table: coercion, contract, first-seen-wins insert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfprice.functions.numeric import empty_to_null, is_not_finite, to_double, to_whole
from shelfprice.plans.joins import BROADCAST_ROWS, is_small
from shelfprice.plans.staging import stage
from shelfprice.plans.topk import first_per_group
from shelfprice.schema import (
    BASE_TYPES,
    FLOAT_COLUMNS,
    INT_COLUMNS,
    MAX_LENGTHS,
    NOT_NULL_COLUMNS,
    ORDER_KEY,
    RAW_COLUMNS,
)


# Names of the number cells of a row that said nan or infinity: they are NULL, but not missing.
NOT_FINITE = "not_finite"
# The broken rules of a row as :func:`check_contract` found them, NULL if there are none.
_CHECKED = "_violations"


def coerce_types(raw: DataFrame, note_not_finite: bool = False) -> DataFrame:
    """Text cells to values: '' is NULL, float and whole-number fields NULL when unparseable.

    Cells that spell a number which is not finite are NULL too; with ``note_not_finite`` a column ``not_finite`` names
    them, by which the contract rejects the row.
    """

    def coerced(name: str) -> Column:
        if name in FLOAT_COLUMNS:
            return to_double(F.col(name))
        if name in INT_COLUMNS:
            return to_whole(F.col(name))
        return empty_to_null(F.col(name)) if raw.schema[name].dataType.simpleString() == "string" else F.col(name)

    numbers = [c for c in raw.columns if c in FLOAT_COLUMNS + INT_COLUMNS]
    noted = []
    if note_not_finite:
        odd = F.array_compact(F.array(*[F.when(is_not_finite(F.col(c)), F.lit(c)) for c in numbers])).cast("array<string>")
        none = ~reduce(lambda a, b: a | b, [is_not_finite(F.col(c)) for c in numbers], F.lit(False))
        noted = [F.when(none, F.array().cast("array<string>")).otherwise(odd).alias(NOT_FINITE)]
    return raw.select(*[coerced(c).alias(c) for c in raw.columns], *noted)


def project_listing(df: DataFrame) -> DataFrame:
    """The eleven listing columns (and order key and odd numbers, if any); a missing column is an error."""
    missing = [c for c in RAW_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"listing columns missing: {missing}")
    return df.select(*RAW_COLUMNS, *[c for c in (ORDER_KEY, NOT_FINITE, _CHECKED) if c in df.columns])


def _as_base_type(name: str) -> Column:
    return F.col(name).try_cast(BASE_TYPES[name])


def _unfit(df: DataFrame, name: str) -> Column:
    """Does a present value have no base-table counterpart? Numbers are compared, not cast."""
    column, target = F.col(name), T.StructType.fromDDL(f"c {BASE_TYPES[name]}")["c"].dataType
    given = df.schema[name].dataType
    if isinstance(given, (T.DoubleType, T.DecimalType)) and isinstance(target, T.DecimalType):
        # Rounding half up to the scale reaches one digit too many from here on.
        return F.abs(column) >= float(10 ** (target.precision - target.scale)) - 0.5 * 10.0**-target.scale
    if isinstance(given, T.IntegralType) and isinstance(target, T.IntegerType):
        return (column > 2**31 - 1) | (column < -(2**31))
    return column.isNotNull() & column.try_cast(target).isNull()


def contract_checks(df: DataFrame) -> dict[str, Column]:
    """Reason to condition for everything that keeps a coerced row out of the base table."""
    checks = {}
    for name, type_ in BASE_TYPES.items():
        if name in NOT_NULL_COLUMNS:
            checks[f"{name} missing"] = F.col(name).isNull()
        if name in MAX_LENGTHS:
            checks[f"{name} too long"] = F.length(name) > MAX_LENGTHS[name]
        if type_ != "string":
            checks[f"{name} not {type_}"] = _unfit(df, name)
        if NOT_FINITE in df.columns and name in FLOAT_COLUMNS + INT_COLUMNS:
            checks[f"{name} not finite"] = F.array_contains(NOT_FINITE, name)
    return {reason: F.coalesce(holds, F.lit(False)) for reason, holds in checks.items()}


def _broken(df: DataFrame) -> Column:
    if _CHECKED in df.columns:
        return F.col(_CHECKED).isNotNull()
    return reduce(lambda a, b: a | b, contract_checks(df).values())


def violations(df: DataFrame) -> Column:
    """ARRAY<STRING> of the broken rules of a row."""
    if _CHECKED in df.columns:
        return F.coalesce(F.col(_CHECKED), F.array().cast("array<string>"))
    return F.array_compact(F.array(*[F.when(holds, F.lit(reason)) for reason, holds in contract_checks(df).items()]))


def check_contract(df: DataFrame) -> DataFrame:
    """The listing columns with the outcome of the contract, for rows that are staged and then read several times.

    :func:`apply_contract` and :func:`quarantined` take it from there instead of checking every row again.
    """
    df = project_listing(df).drop(_CHECKED)
    return df.withColumn(_CHECKED, F.when(_broken(df), violations(df)))


def apply_contract(df: DataFrame, mode: str = "quarantine") -> DataFrame:
    """Valid rows in base-table types.

    ``quarantine`` leaves bad rows out (see :func:`quarantined`); ``fail`` makes the first bad row
    fail the job, so that nothing of the load is committed.
    """
    df = project_listing(df)
    ok = ~_broken(df)
    if mode == "fail":
        message = F.concat(F.lit("listing rejected: "), F.array_join(violations(df), ", "))
        ok = F.when(ok, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    elif mode != "quarantine":
        raise ValueError(f"unknown contract mode {mode!r}")
    keep = [ORDER_KEY] if ORDER_KEY in df.columns else []
    return df.where(ok).select(*[F.col(c).try_cast(BASE_TYPES[c]).alias(c) for c in RAW_COLUMNS], *keep)


def quarantined(df: DataFrame) -> DataFrame:
    """Rows that break the contract, with the broken rules in ``violations``."""
    df = project_listing(df)
    return df.where(_broken(df)).withColumn("violations", violations(df)).drop(NOT_FINITE, _CHECKED)


# URLs that occur more than once travel to all executors as 64-bit codes, up to so many (about 100 MB).
MOST_REPEATED = 4_000_000
# A URL with more rows than this is cut down before its rows are shuffled.
HOT_ROWS = 10_000


def _first_by_url(rows: DataFrame, *order: Column) -> DataFrame:
    """First row of each URL by ``order``, and every row without a URL.

    Most URLs occur once, and their rows need not meet any other. So codes of the URLs are counted first, in a shuffle of
    eight bytes a row, and whole rows are shuffled only where the code is repeated. (Different URLs with one code are told
    apart there.) Where more URLs are repeated than may be broadcast, all rows take that way. ``rows`` is read three times.
    """
    url = F.col("product_url")
    # A NULL URL never conflicts. Giving such a row its own order key as a second key part keeps
    # all of them and spreads them evenly. The hash of both leads only to make sorting cheap: URLs of
    # one site start alike, so comparing their first bytes, as the sort does, tells nothing.
    own = F.when(url.isNull(), F.to_json(F.struct(ORDER_KEY)))
    keys = [F.col("_key"), url, F.col("_own")]
    rows = rows.withColumn("_key", F.xxhash64(url, own))

    def first(met: DataFrame) -> DataFrame:
        return first_per_group(met.withColumn("_own", own), keys, *order).drop("_key", "_own")

    counts = stage(rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "repeated_urls")
    repeated, most = counts.agg(F.count(F.lit(1)), F.coalesce(F.max("_n"), F.lit(0))).first()
    if repeated > MOST_REPEATED:
        # Cutting hot URLs down means sorting all rows before the shuffle too.
        return first(rows if most > HOT_ROWS else rows.repartition("_key"))
    codes = F.broadcast(counts.select("_key"))
    alone = rows.join(codes, "_key", "left_anti").drop("_key")
    return alone.unionByName(first(rows.join(codes, "_key", "left_semi")))


def first_wins(batch: DataFrame) -> DataFrame:
    """Keep the first row of each URL by order key, and every row without a URL."""
    return _first_by_url(batch, F.col(ORDER_KEY))


def insert_if_absent(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of ``batch`` to append to ``stored``: first of each URL that is not stored yet.

    Stored URLs join the ranking as rows that precede the whole batch, so one ranking by URL
    answers both "first in the batch" and "already stored".
    """
    taken = stored.where(F.col("product_url").isNotNull()).select("product_url", F.lit(0).alias("_new"))
    both = batch.withColumn("_new", F.lit(1)).unionByName(taken, allowMissingColumns=True)
    return _first_by_url(both, F.col("_new"), F.col(ORDER_KEY)).where("_new = 1").drop("_new")


def reduce_stored(stored: DataFrame, batch: DataFrame, max_broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Shrink ``stored`` to the URLs of a small batch, so that a large table is not shuffled.

    ``batch`` must be cheap to measure (staged). A batch above the bounds leaves ``stored`` as it is;
    the insert is exact either way.
    """
    urls = batch.where(F.col("product_url").isNotNull()).select("product_url")
    if not is_small(urls, max_broadcast_rows):
        return stored
    return stored.join(F.broadcast(urls.distinct()), "product_url", "left_semi")


def load_counts(raw: DataFrame) -> DataFrame:
    """Rows per platform as spelled in the files; a missing platform counts as "unknown"."""
    return raw.groupBy(F.coalesce("platform", F.lit("unknown")).alias("platform")).agg(
        F.count(F.lit(1)).alias("listings")
    )


def load_summary(batch: DataFrame, inserted: DataFrame, stored: DataFrame, keys: Sequence[str] = ("platform",)) -> DataFrame:
    """Per platform (or other keys): rows offered, inserted and skipped. Platforms with no insert show 0."""

    def tally(df: DataFrame, offered: int, added: int) -> DataFrame:
        return df.groupBy(*keys).agg(
            (F.count(F.lit(1)) * offered).alias("offered"), (F.count(F.lit(1)) * added).alias("inserted")
        )

    parts = tally(batch, 1, 0).unionByName(tally(inserted, 0, 1)).unionByName(tally(stored, 0, 0))
    return (
        parts.groupBy(*keys)
        .agg(F.sum("offered").alias("offered"), F.sum("inserted").alias("inserted"))
        .withColumn("skipped", F.col("offered") - F.col("inserted"))
    )


def discounted_listings(listings: DataFrame) -> DataFrame:
    """Listings that state a discount; 0 % counts."""
    return listings.where(F.col("discount_pct").isNotNull())
