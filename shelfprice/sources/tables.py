"""Listing tables: Parquet for the chain, JDBC to take over an existing database."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfprice.plans.staging import stage
from shelfprice.schema import BASE_TYPES, CLEANED_TYPES, ORDER_KEY, RAW_COLUMNS
from shelfprice.sources.clustered import ROWS_PER_FILE, Wanted, along_curve, file_ranges, files_with
from shelfprice.sources.csv import WRITE_OPTIONS
from shelfprice.sources.snapshots import file_system, put_json, read_json

# A versioned table is a folder of versions and this file, which names the current one and its columns.
_CURRENT = "_current.json"
# Ranges of the files of a clustered version, in a folder that scans of the version pass over.
_RANGES = "_ranges"
# Directory names cannot hold an empty platform; it and what starts alike are written behind this sign.
_SIGN = "\u2205"


def _named(platform: Column) -> Column:
    return F.when((platform == "") | platform.startswith(_SIGN), F.concat(F.lit(_SIGN), platform)).otherwise(platform)


def _unnamed(platform: Column) -> Column:
    return F.when(platform.startswith(_SIGN), F.substring(platform, 2, 1_000_000)).otherwise(platform)


def read_listings(spark: SparkSession, path: str, wanted: Wanted | None = None) -> DataFrame:
    """Scan of a listing table. Not sorted: order-sensitive operators use the order key.

    A table of :func:`write_cleaned` has the columns it was written with. Of other Parquet files the
    columns are taken from the files, but those of directory names are always text: "007" stays as it is.

    ``wanted`` names ranges of columns that the caller goes on to filter by: of a clustered table only the files
    that may hold such rows are opened.
    """
    current = _read_current(spark, path)
    if current is None:
        found = spark.read.option("recursiveFileLookup", False).parquet(path).schema
        texts = [T.StructField(f.name, T.StringType() if f.name in BASE_TYPES and BASE_TYPES[f.name] == "string" else f.dataType) for f in found]
        return spark.read.schema(T.StructType(texts)).parquet(path)
    schema = T.StructType.fromJson(current["schema"])
    version = f"{path.rstrip('/')}/{current['version']}"
    if wanted and current.get("clustered"):
        files = files_with(spark, spark.read.parquet(f"{version}/{_RANGES}"), wanted)
        if not files:
            return spark.createDataFrame([], schema)
        table = spark.read.schema(schema).option("basePath", version).parquet(*files)
    else:
        table = spark.read.schema(schema).parquet(version)
    return table.withColumn("platform", _unnamed(F.col("platform"))).select(*schema.names)


def _read_current(spark: SparkSession, path: str) -> dict | None:
    name = f"{path.rstrip('/')}/{_CURRENT}"
    file, system = file_system(spark, name)
    return read_json(spark, name) if system.exists(file) else None


def read_listings_jdbc(
    spark: SparkSession, url: str, table: str, lower_id: int, upper_id: int, partitions: int, **options: str
) -> DataFrame:
    """Parallel scan of a database table by ranges of its serial ``id``, which becomes the order key."""
    df = (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn="id", **options)
        .options(lowerBound=lower_id, upperBound=upper_id, numPartitions=partitions)
        .load()
    )
    return df.withColumnRenamed("id", ORDER_KEY)


def write_cleaned(
    cleaned: DataFrame, path: str, rebalance: bool = True, cluster_by: Sequence[str] = (), rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Replace the cleaned table, partitioned by platform.

    The rows go to a version folder of their own; then one small file is replaced that names the version
    to read. A reader sees the old table or the new one, a failed write leaves the old one, and the rows
    may come from the table itself. The version before stays for plans that still read it; older ones go.

    ``rebalance`` shuffles once into evenly sized files, splitting a platform that holds much of the
    rows; without it every task writes a file of its own per platform. ``cluster_by`` lays the rows of each platform
    out along a curve over these columns instead, in files of about ``rows_per_file``, for readers that ask for ranges.
    """
    spark, path = cleaned.sparkSession, path.rstrip("/")
    rest = [c for c in cleaned.columns if c not in RAW_COLUMNS]
    typed = cleaned.select(*[F.col(c).cast(CLEANED_TYPES[c]).alias(c) for c in RAW_COLUMNS], *rest)
    before = _read_current(spark, path)
    version = f"v-{uuid.uuid4().hex}"
    named = typed.withColumn("platform", _named(F.col("platform")))
    if cluster_by:
        named = along_curve(stage(named, "to_cluster"), cluster_by, "platform", rows_per_file)
    elif rebalance:
        named = named.hint("rebalance", "platform")
    writer = named.write.option("maxRecordsPerFile", rows_per_file) if cluster_by else named.write
    writer.partitionBy("platform").parquet(f"{path}/{version}")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in typed.schema])
    if cluster_by:
        written = spark.read.schema(schema).parquet(f"{path}/{version}")
        file_ranges(written, cluster_by).write.parquet(f"{path}/{version}/{_RANGES}")
    current = {"version": version, "before": before and before["version"], "schema": schema.jsonValue(), "clustered": list(cluster_by)}
    put_json(spark, f"{path}/{_CURRENT}", current, replace=True)
    if before and before["before"]:
        folder, system = file_system(spark, f"{path}/{before['before']}")
        system.delete(folder, True)


def write_export(view: DataFrame, path: str) -> None:
    """CSV of a browsing view."""
    columns = [c for c in view.columns if c != ORDER_KEY]
    view.select(*columns).write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)
