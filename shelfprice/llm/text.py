"""Words, lines and carried rows, shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Space, tab, line feed, vertical tab, form feed and carriage return part words; nothing else does.
BLANKS = r"[\x20\x09-\x0D]+"
ROW = "_row"


def words(text: Column) -> Column:
    """Words of a text in order; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def carried(df: DataFrame, *more: Column) -> DataFrame:
    """``df`` with its whole row packed in one column, so that no name can clash with those of an operator."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(ROW), *more)


def unpacked(df: DataFrame, *more: Column | str) -> DataFrame:
    """The rows packed by ``carried``, with further columns behind them."""
    return df.select(f"{ROW}.*", *more)


def pairwise(values: Column, distance: int, size: Column, combine) -> Column:
    """``combine(values[i], values[i + distance])`` for every i that has both; ``size`` is the length of ``values``."""
    n = F.greatest(size - distance, F.lit(0))
    return F.zip_with(F.slice(values, 1, n), F.slice(values, 1 + distance, n), combine)


def unit_interval(*parts: Column | str, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the values alone, so that a retried task draws the same."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11)
    return bits.cast("double") / float(1 << 53)
