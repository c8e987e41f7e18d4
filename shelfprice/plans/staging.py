"""Intermediate tables in the cluster's shared folder.

A staged table cuts lineage with files that outlive any executor, is computed once however often
it is read, and gives later plans true file sizes. The folder is the session's
``spark.checkpoint.dir``; only a local session without that setting gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def _is_one_process(master: str) -> bool:
    """Whether driver and executor are one; ``local-cluster`` starts executors of their own."""
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """Run-specific folder below ``spark.checkpoint.dir``."""
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not _is_one_process(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="run-")
        root = _local_folders[app]
    return f"{root.rstrip('/')}/shelfprice-{app}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and return a scan of the written files."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """A staged table that is deleted at the end of the block, for work that ends inside it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, path)


def drop_staged(spark: SparkSession) -> None:
    """Delete everything this application staged. Call when no staged table is read any more."""
    _delete(spark, shared_folder(spark))


def delete_matching(spark: SparkSession, pattern: str, keep: frozenset[str] | set[str] = frozenset()) -> None:
    """Delete the folders that match a glob pattern, if any, but those of these names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    for status in found or ():
        if status.getPath().getName() not in keep:
            _delete(spark, status.getPath().toString())


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
