"""Rounding and guarded casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number in a raw text field. Gating the cast keeps Java-only spellings such as
# "12f" or "1.5d", and "nan" / "inf", out.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

# Text that number parsers read as a number that is not finite.
NOT_FINITE_PATTERN = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"


def rint2(x: Column) -> Column:
    """Two decimals, ties to even on the scaled binary value (the rounding of numeric arrays)."""
    return F.rint(x * 100) / 100


def rint6(x: Column) -> Column:
    """Six decimals. Makes interpolated quantiles and means independent of their last bits."""
    return F.rint(x * 1000000) / 1000000


def empty_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def to_double(text: Column) -> Column:
    """Text to DOUBLE; anything that is not a plain finite number becomes NULL."""
    number = F.when(text.rlike(NUMBER_PATTERN), F.trim(text)).try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def is_not_finite(text: Column) -> Column:
    """Whether a cell spells NaN or infinity, or a number beyond all doubles."""
    number = F.when(text.rlike(NUMBER_PATTERN), F.trim(text)).try_cast("double")
    odd = F.coalesce(text.rlike(NOT_FINITE_PATTERN) | (F.abs(number) == float("inf")), F.lit(False))
    # A finite number, which the row is read for anyway, need not be looked at again.
    return F.when(to_double(text).isNotNull(), F.lit(False)).otherwise(odd)


def to_whole(text: Column) -> Column:
    """Text to BIGINT by truncating a float towards zero."""
    return to_double(text).try_cast("bigint")


def finite_or_null(x: Column) -> Column:
    """NaN is a value to Spark and missing to this library: fold it into NULL once, at ingest."""
    return F.when(~F.isnan(x), x)


def exact_sum(x: Column, times: Column | None = None) -> Column:
    """Aggregate: sum to six decimals as DOUBLE, independent of the order of the rows.

    Whole and fractional parts are summed as BIGINT, so partial sums of any partitioning agree and a
    mean that falls on a rounding tie rounds the same way every time. ``times`` weights each value.
    """
    whole = F.floor(x)
    part = F.rint((x - whole) * 1000000).cast("bigint")
    if times is not None:
        whole, part = whole * times, part * times
    return F.sum(whole).cast("double") + F.sum(part).cast("double") / 1000000


def exact_mean(x: Column) -> Column:
    """Aggregate: mean of the non-null values; NULL when there are none."""
    return F.try_divide(exact_sum(x), F.count(x))
