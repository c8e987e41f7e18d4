"""Text expressions with Unicode-aware blanks and letters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separators that also count as blank, for patterns and, one
# by one, for trimming without a pattern.
_BLANK = r"\s\x1c-\x1f"
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_WORD_SEPARATORS = rf"(?U)[{_BLANK}\-/|]+"
_CASED = r"\p{IsUppercase}\p{IsLowercase}\p{IsTitlecase}"
_CASE_RUNS = rf"([{_CASED}]+|[^{_CASED}]+)"


def strip(text: Column) -> Column:
    """Drop blanks on both ends (all Unicode blanks; SQL trim drops only U+0020)."""
    return F.btrim(text, F.lit(BLANKS))


def title_case(text: Column) -> Column:
    """Capital after every non-letter: h&m -> H&M, levi's -> Levi'S, 3m -> 3M (initcap differs)."""
    runs = F.regexp_extract_all(text, F.lit(_CASE_RUNS), F.lit(1))
    recased = F.transform(
        runs, lambda run: F.concat(F.upper(F.substring(run, 1, 1)), F.lower(run.substr(F.lit(2), F.length(run))))
    )
    return F.array_join(recased, "")


def first_word_title(name: Column) -> Column:
    """Brand guess: first piece of the name, title-cased; NULL when the name starts with a separator."""
    first = F.split(strip(name), _WORD_SEPARATORS)[0]
    return F.nullif(title_case(first), F.lit(""))


def iso_seconds(timestamp: Column) -> Column:
    """Zone-free timestamp as ISO text, cut to the second. A cast, so no session zone takes part."""
    return F.replace(F.substring(timestamp.cast("string"), 1, 19), F.lit(" "), F.lit("T"))


def normalise_platform(platform: Column) -> Column:
    return strip(F.lower(platform))


def is_junk_name(name: Column) -> Column:
    """NULL, at most one character, or digits only (after dropping outer blanks)."""
    stripped = strip(name)
    return name.isNull() | (F.length(stripped) <= 1) | stripped.rlike(r"(?U)^\d+$")
