"""Texts that are the same up to white space, by distributed radix partitioning from the first byte on.

A text is normalised (every run of white space is one space) and read as bytes. All documents start as one group.
Each round reads the next digit of every text that still shares its group, a run of successive bytes, and
splits the groups by it: texts with one digit stay together. A group leaves when it has a single member, or
when its texts have ended, which a digit shorter than asked for says; texts of an ended group are equal byte by
byte, so no digest decides anything. Digits grow by ``GROWTH`` from round to round, so the
rounds grow with the logarithm of the longest text that still has company, not with its length.

At scale: a round counts (group, digit) with map-side combine, so a group of a third of all rows is one row per
task. Only groups of two and more come back to the rows, by broadcast if the measured table is small, otherwise
by one shuffle in which hot groups are spread. Rows without company leave in the round that finds it, and with
them their texts; what goes on carries only the bytes not read yet. No group is ever collected.

Of equal texts the row with the smallest document id stays; rows without an id come after all others, and rows
that agree in id and text are told apart by a number, so that exactly one row of a group stays.

Defined results: NULL counts as the empty text, and all empty texts are one group; text that is only white space
is one space; an empty table gives an empty result; other columns of the input do not matter to
``exact_groups`` and are all kept by ``keep_first``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfprice.llm.text import BLANKS, ROW, carried, unpacked
from shelfprice.plans.joins import BROADCAST_ROWS, attach_groups
from shelfprice.plans.staging import stage

DIGIT_BYTES = 64
GROWTH = 8


def _numbered(docs: DataFrame) -> DataFrame:
    """All rows, packed, with a number of their own that is written with them and so never changes."""
    return carried(docs, F.monotonically_increasing_id().alias("row"))


def _digit(text: Column, width: int) -> tuple[Column, Column]:
    """The next digit of the bytes that are left, and what is left behind it."""
    return F.substring(text, 1, width).alias("digit"), F.substring(text, F.lit(width + 1), F.octet_length(text)).alias("rest")


def _rounds(numbered: DataFrame, digit_bytes: int, growth: int, max_broadcast_rows: int) -> list[DataFrame]:
    """Per round, the rows that leave in it: ``row, doc_id, text_sha256`` and ``node``, NULL for one without company."""
    normal = F.regexp_replace(F.coalesce("text", F.lit("")), BLANKS, " ")
    texts = numbered.select("row", f"{ROW}.doc_id", f"{ROW}.text").select("row", "doc_id", normal.alias("text"))
    first = texts.select("row", "doc_id", F.sha2("text", 256).alias("text_sha256"), F.col("text").cast("binary").alias("text"))
    width = digit_bytes
    known = ["row", "doc_id", "text_sha256"]
    going = stage(first.select(*known, F.lit(0).cast("long").alias("node"), *_digit(F.col("text"), width)), "radix")
    left = []
    while True:
        # The smallest row number of a group names it.
        groups = going.groupBy("node", "digit").agg(F.min("row").alias("next"), F.count(F.lit(1)).alias("n")).where("n > 1")
        met = attach_groups(going, groups, ["node", "digit"], max_broadcast_rows=max_broadcast_rows)
        ended = F.octet_length("digit") < width
        width *= growth
        digit, rest = _digit(F.col("rest"), width)
        stays = F.col("next").isNotNull() & ~ended
        split = met.select(
            *known,
            F.col("next").alias("node"),
            F.when(stays, digit).alias("digit"),
            F.when(stays, rest).alias("rest"),
            stays.alias("going"),
        )
        split = stage(split, "radix", ["going"])
        left.append(split.where("NOT going").select(*known, "node"))
        going = split.where("going").drop("going")
        if going.isEmpty():
            return left


def _groups(numbered: DataFrame, digit_bytes: int, growth: int, max_broadcast_rows: int) -> DataFrame:
    """``row, doc_id, keep_row, keep_id, group_size, text_sha256`` of every row."""
    left = _rounds(numbered, digit_bytes, growth, max_broadcast_rows)
    rows = left[0]
    for more in left[1:]:
        rows = rows.unionByName(more)
    alone = rows.where("node IS NULL").select(
        "row", "doc_id", F.col("row").alias("keep_row"), F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256"
    )
    shared = rows.where("node IS NOT NULL")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    kept = shared.groupBy("node").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size"))
    kept = kept.select("node", F.col("first.row").alias("keep_row"), F.col("first.doc_id").alias("keep_id"), "group_size")
    equal = attach_groups(shared, kept, ["node"], how="inner", max_broadcast_rows=max_broadcast_rows)
    return alone.unionByName(equal.select(*alone.columns))


def exact_groups(
    docs: DataFrame, digit_bytes: int = DIGIT_BYTES, growth: int = GROWTH, max_broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    groups = _groups(_numbered(docs), digit_bytes, growth, max_broadcast_rows)
    return groups.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


def keep_first(
    docs: DataFrame, digit_bytes: int = DIGIT_BYTES, growth: int = GROWTH, max_broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """The documents that stay, as they came."""
    numbered = stage(_numbered(docs), "radix_rows")
    groups = _groups(numbered, digit_bytes, growth, max_broadcast_rows)
    dropped = groups.where("row != keep_row").select("row")
    return unpacked(numbered.join(dropped, "row", "left_anti"))
