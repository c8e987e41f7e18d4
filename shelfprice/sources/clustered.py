"""Rows laid out along a space-filling curve, so that files hold narrow ranges of several columns at once.

Every column gets a rank among ``1 << BITS`` ranges of about equally many rows; the bits of all ranks are
interleaved into one key (a Z-curve), and rows are range-partitioned by it. Equal keys are spread by a hash of the row, so a brand
that holds a third of all rows fills many files. Each file's least and greatest values are kept beside the rows: a
reader that asks for ranges opens only the files they may lie in.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfprice.schema import ORDER_KEY

CLUSTER_BY = ("brand", "current_price", "category", "scraped_at")
BITS = 8
ROWS_PER_FILE = 1_000_000
# Rows that a task lays out at least, if there are more than the usual number of tasks.
ROWS_PER_TASK = 500_000
# Rows by which the ranges are chosen, those with the least hashes; ranges need not be exact to be balanced.
SAMPLE = 20_000

Wanted = dict[str, list | tuple]


def range_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, list]:
    """Per column the values that part its rows into ranges of about equal size, by a bounded sample of the rows."""
    sample = df.select(*columns).orderBy(_spread(df)).limit(SAMPLE).collect()
    bounds = {}
    for column in columns:
        known = sorted(row[column] for row in sample if row[column] is not None)
        bounds[column] = [known[len(known) * i // (1 << BITS)] for i in range(1, 1 << BITS)] if known else []
    return bounds


def _spread(df: DataFrame) -> Column:
    """A hash that differs from row to row: of the unique order key, where there is one."""
    return F.xxhash64(ORDER_KEY) if ORDER_KEY in df.columns else F.xxhash64(*df.columns)


def _table(bounds: list, kind: str) -> Column:
    return F.array(*[F.lit(str(b) if kind.startswith("timestamp") else b).cast(kind) for b in bounds])


def _rank(value: Column, bounds: list, kind: str) -> Column:
    """How many bounds are not above the value, by halving; NULL ranks first. The plain form of what the curve does."""
    if not bounds:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(BITS))])
    return F.aggregate(steps, F.lit(0), lambda low, step: low + F.when(F.get(_table(bounds, kind), low + step - 1) <= value, step).otherwise(0))


def curve_key(df: DataFrame, bounds: dict[str, list]) -> DataFrame:
    """``df`` with its place on the curve in ``_curve``, to sort and part rows by; to filter by it, stage the rows first."""
    kinds = dict(df.dtypes)
    ranks = {f"_rank_{i}": name for i, name in enumerate(bounds)}
    tables = {rank: _table(bounds[name], kinds[name]) for rank, name in ranks.items() if bounds[name]}
    # The halving of _rank for all columns, a projection a step: these are compiled, a loop over an array is not.
    ranked = df.withColumns({rank: F.lit(0) for rank in ranks})
    for step in (1 << i for i in reversed(range(BITS))):
        more = {rank: F.get(table, F.col(rank) + (step - 1)) <= F.col(ranks[rank]) for rank, table in tables.items()}
        ranked = ranked.withColumns({rank: F.col(rank) + F.when(found, step).otherwise(0) for rank, found in more.items()})
    # Every rank with its bits as far apart as the ranks need; looked up, as moving them one by one makes long code.
    apart = F.array(*[F.lit(sum((rank >> bit & 1) << bit * len(ranks) for bit in range(BITS))).cast("long") for rank in range(1 << BITS)])
    bits = [F.shiftleft(F.get(apart, F.col(rank)), place) for place, rank in enumerate(ranks)]
    return ranked.withColumn("_curve", reduce(lambda a, b: a + b, bits)).drop(*ranks)


def along_curve(df: DataFrame, columns: Sequence[str], within: str, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """The rows in range partitions along the curve, each value of ``within`` by itself. ``df`` is read several times, so stage it.

    A partition may hold the rows of many files, in their order; the writer cuts them (``maxRecordsPerFile``). So tasks and
    blocks of the shuffle do not multiply where files are small.
    """
    rows, tasks = df.count(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(-(-rows // rows_per_file), max(tasks, -(-rows // ROWS_PER_TASK))))
    keyed = curve_key(df, range_bounds(df, columns))
    return keyed.repartitionByRange(parts, within, "_curve", _spread(df)).sortWithinPartitions(within, "_curve").drop("_curve")


def file_ranges(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``file`` and, per column, least and greatest value of a table that was just written."""
    ends = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("least", F.min), ("most", F.max))]
    return rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(*ends)


def _may_hold(name: str, wanted: list | tuple) -> Column:
    least, most = F.col(f"least_{name}"), F.col(f"most_{name}")
    if isinstance(wanted, list):
        return reduce(lambda a, b: a | b, [(least <= F.lit(v)) & (most >= F.lit(v)) for v in wanted], F.lit(False))
    low, high = wanted
    above = F.lit(True) if low is None else most >= F.lit(low)
    return above & (F.lit(True) if high is None else least <= F.lit(high))


def files_with(spark: SparkSession, ranges: DataFrame, wanted: Wanted) -> list[str]:
    """Files that may hold rows in all of the wanted ranges: ``(least, greatest)`` with None for open, or a list of values.

    Columns that were not clustered tell nothing. The driver gets names of files, as from any listing.
    """
    known = [_may_hold(c, w) for c, w in wanted.items() if f"least_{c}" in ranges.columns]
    hit = ranges.where(reduce(lambda a, b: a & b, known, F.lit(True))).select("file")
    return sorted(unquote(row.file) for row in hit.toLocalIterator())
