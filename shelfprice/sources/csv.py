"""Raw CSV drops: header-bound reading and writing."""

from __future__ import annotations

import csv as text_csv
import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfprice.plans.staging import delete_matching
from shelfprice.schema import ORDER_KEY, RAW_COLUMNS, RAW_SCHEMA

# Drops are *.csv files, directly in the folder or in one directory per run.
CSV_FILES = {"pathGlobFilter": "*.csv", "recursiveFileLookup": True}
_OPTIONS = {**CSV_FILES, "multiLine": True, "escape": '"', "encoding": "UTF-8", "mode": "PERMISSIVE"}
# A file up to this size fits into a task as one text.
WHOLE_FILE_BYTES = 64 * 1024 * 1024

# Cells are written as they are: by default Spark would trim their outer blanks.
WRITE_OPTIONS = {
    "header": True,
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def first_lines(spark: SparkSession, paths: str | list[str], whole_up_to: int = WHOLE_FILE_BYTES) -> DataFrame:
    """``path, header``: first line of every non-empty file, found by the tasks that read the files.

    Files up to a size are read as one text each and cut at the first line end. Larger ones are read
    by line in parallel, where each task keeps one line per file before anything is shuffled. The
    condition on the size prunes the list of files, so no file is read twice.
    """
    path, size = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size")
    reader = spark.read.options(**CSV_FILES)
    small = reader.text(paths, wholetext=True).where((size <= whole_up_to) & (F.col("value") != ""))
    cut = F.substring_index(F.substring_index("value", "\n", 1), "\r", 1)
    lines = reader.text(paths).where((size > whole_up_to) & (F.col("_metadata.file_block_start") == 0))
    numbered = lines.select(path, F.monotonically_increasing_id().alias("line_no"), "value")
    large = numbered.groupBy("path").agg(F.min_by("value", "line_no").alias("header"))
    return small.select(path, cut.alias("header")).unionByName(large)


def read_raw_csv(spark: SparkSession, paths: str | list[str], uniform_header: list[str] | None = None) -> DataFrame:
    """All cells as text, bound to columns by header name, with an order key (file path, row in file).

    Spark binds CSV cells by position, so files are grouped by their header line and each group is
    read with its own columns: one scan per distinct header, not per file. Missing columns are NULL,
    extra cells ignored. ``uniform_header`` skips the grouping for drops written with one known
    header; a file with another header then fails the job instead of shifting its cells.
    """
    if uniform_header is not None:
        schema = ", ".join(f"`{c}` STRING" for c in uniform_header)
        reader = spark.read.options(**_OPTIONS, header=True, enforceSchema=False).schema(schema)
        return _ordered(reader.csv(paths))
    # One short row per file, as many as the file listing that the driver holds anyway.
    groups: dict[str, list[str]] = {}
    for row in first_lines(spark, paths).toLocalIterator():
        groups.setdefault(row["header"].lstrip("\ufeff"), []).append(row["path"])
    merged = None
    for header, files in sorted(groups.items()):
        names = next(text_csv.reader([header]))
        # A repeated name binds to its last cell, so earlier ones are read under throw-away names.
        last = {name: i for i, name in enumerate(names)}
        fields = [name if last[name] == i and name else f"_unused_{i}" for i, name in enumerate(names)]
        schema = ", ".join(f"`{name.replace('`', '``')}` STRING" for name in fields)
        part = _ordered(spark.read.options(**_OPTIONS, header=True).schema(schema).csv(files))
        part = part.drop(*[f for f in fields if f.startswith("_unused_")])
        merged = part if merged is None else merged.unionByName(part, allowMissingColumns=True)
    if merged is None:
        return _ordered(spark.createDataFrame([], RAW_SCHEMA), from_files=False)
    return merged


def _ordered(df: DataFrame, from_files: bool = True) -> DataFrame:
    # A multi-line CSV file is read by one task from start to end, so the id rises within a file.
    path = F.col("_metadata.file_path") if from_files else F.lit("")
    key = F.struct(path.alias("path"), F.monotonically_increasing_id().alias("row"))
    return df.select(*df.columns, key.alias(ORDER_KEY))


def run_name(site: str, captured_at: datetime.datetime | None = None, category: str = "fashion") -> str:
    """Name of a capture run; names of one site sort by time, and loads read drops in name order."""
    return f"{site}_{category}_{captured_at or datetime.datetime.now():%Y%m%d_%H%M%S}"


def write_raw_csv(listings: DataFrame, folder: str, run: str, columns: list[str] | None = None) -> str:
    """Write a drop ``folder/run`` in the fixed column order, NULL as empty; returns its path.

    Every run is a directory of its own, so drops never overwrite each other. An empty batch writes
    nothing and returns "".
    """
    path = f"{folder.rstrip('/')}/{run}"
    # Rows are counted as they are written, so the input runs once.
    written = Observation()
    out = listings.select(*(columns or RAW_COLUMNS)).observe(written, F.count(F.lit(1)).alias("rows"))
    out.write.options(**WRITE_OPTIONS).csv(path)
    if not written.get["rows"]:
        delete_matching(listings.sparkSession, path)
        return ""
    return path
