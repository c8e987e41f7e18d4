"""Card text to values. Text that holds no usable number gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfprice.functions.numeric import empty_to_null


def parse_price(text: Column, cut_range: Column | bool = True) -> Column:
    """Price text to DOUBLE.

    With ``cut_range`` only the part before the first "-" counts, so a range gives its lower bound;
    without it every digit and dot of the text is kept ("12 - 20" gives 1220).
    """
    cut = F.lit(cut_range) if isinstance(cut_range, bool) else cut_range
    kept = F.when(cut, F.substring_index(text, "-", 1)).otherwise(text)
    return empty_to_null(F.regexp_replace(kept, r"[^0-9.]", "")).try_cast("double")


def parse_first_number(text: Column) -> Column:
    """First run of digits and dots as DOUBLE; signs and everything around it are ignored."""
    return empty_to_null(F.regexp_extract(text, r"[0-9.]+", 0)).try_cast("double")


def parse_discount(text: Column) -> Column:
    return parse_first_number(text)


def parse_rating(text: Column) -> Column:
    return parse_first_number(text)


def parse_count(text: Column) -> Column:
    """Count text to BIGINT: "(1,234)" gives 1234, "1.2k sold" gives 1200 (product truncated)."""
    has_thousands = text.rlike(r"(?i)[0-9.]+\s*k")
    thousands = empty_to_null(F.regexp_extract(text, r"(?i)([0-9.]+)\s*k", 1)).try_cast("double")
    plain = F.replace(F.regexp_extract(text, r"[0-9,]+", 0), F.lit(","), F.lit(""))
    return F.when(has_thousands, (thousands * 1000).try_cast("bigint")).otherwise(
        empty_to_null(plain).try_cast("bigint")
    )


def site_root(page_url: Column) -> Column:
    """Scheme and host of the captured page, the base for its relative links."""
    return F.regexp_extract(page_url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+", 0)


def absolutise_url(href: Column, base: Column, keep_unrooted: Column | bool = False) -> Column:
    """Link target to absolute URL.

    ``keep_unrooted`` is the rule of layout L: "//x" gets https, "/x" the base, the rest (also the
    empty string) stays. Otherwise "/x" gets the base, "http..." stays, and the rest is appended to
    base + "/", so cards without a link all share the URL base + "/".
    """
    keep = F.lit(keep_unrooted) if isinstance(keep_unrooted, bool) else keep_unrooted
    target = F.coalesce(href, F.lit(""))
    return (
        F.when(keep & target.startswith("//"), F.concat(F.lit("https:"), target))
        .when(target.startswith("/"), F.concat(base, target))
        .when(keep | target.startswith("http"), target)
        .otherwise(F.concat(base, F.lit("/"), target))
    )


def assign_prices(sale: Column, regular: Column, has_sale: Column | None = None) -> tuple[Column, Column]:
    """(current, original) from a sale price shown only on reduced cards and a regular price."""
    reduced = sale.isNotNull() if has_sale is None else has_sale
    return F.when(reduced, sale).otherwise(regular), F.when(reduced, regular)
