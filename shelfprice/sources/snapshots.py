"""Committed states of a table that grows by loads.

A load writes folders of its own, which nobody reads yet, and then commits: a manifest file that lists all loads up to it
gets its name, the number of the new state. A file is complete before it gets that name, and a name is given once: of two writers
that start from one state the second is refused, and a reader that picked a state goes on with it whatever is committed
meanwhile. Folders of loads that never committed are seen by nobody.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_MANIFESTS = "_manifests"


class StaleSnapshot(Exception):
    """Another writer has committed since the snapshot was read."""


@dataclass(frozen=True)
class Snapshot:
    """The loads of a table, oldest first, each a dict with its ``load_id`` and what its writer noted."""

    table: str
    version: int = 0
    loads: tuple[dict, ...] = ()
    notes: dict = field(default_factory=dict)

    def folders(self, part: str) -> list[str]:
        """Folders of one part (rows, summary, ...) of all loads that have it."""
        return [load_folder(self.table, part, load["load_id"]) for load in self.loads if part in load["parts"]]

    def read(self, spark: SparkSession, part: str, schema: T.StructType | str, folders: list[str] | None = None) -> DataFrame:
        """Rows of one part of all loads (or of some), with ``load_id`` if the schema names it."""
        folders = self.folders(part) if folders is None else folders
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", f"{self.table}/{part}").parquet(*folders)


def load_folder(table: str, part: str, load_id: str) -> str:
    return f"{table}/{part}/load_id={load_id}"


def file_system(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def read_json(spark: SparkSession, path: str) -> dict:
    file, system = file_system(spark, path)
    stream = system.open(file)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def put_json(spark: SparkSession, path: str, content: dict, replace: bool) -> bool:
    """Write a file that appears whole under its name; without ``replace`` False if there is one already."""
    folder, _, name = path.rpartition("/")
    new, system = file_system(spark, f"{folder}/.{uuid.uuid4().hex}.json")
    stream = system.create(new, True)
    stream.write(json.dumps(content).encode())
    stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE if replace else rename.NONE
    target, _ = file_system(spark, path)
    try:
        context.rename(system.makeQualified(new), system.makeQualified(target), options)
    except Exception:
        system.delete(new, False)
        if replace or not system.exists(target):
            raise
        return False
    return True


def _manifest(table: str, version: int) -> str:
    return f"{table}/{_MANIFESTS}/{version:012d}.json"


def read_snapshot(spark: SparkSession, table: str, version: int | None = None) -> Snapshot:
    """The last committed state of a table, or an earlier one; before the first commit an empty one."""
    table = table.rstrip("/")
    if version is None:
        folder, system = file_system(spark, f"{table}/{_MANIFESTS}")
        names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
        version = max((int(n.removesuffix(".json")) for n in names if n[0].isdigit()), default=0)
    if not version:
        return Snapshot(table)
    found = read_json(spark, _manifest(table, version))
    return Snapshot(table, version, tuple(found["loads"]), found["notes"])


def commit(spark: SparkSession, snapshot: Snapshot, load: dict, notes: dict | None = None) -> Snapshot:
    """The state after one more load; refused if the table has moved on since ``snapshot``."""
    loads, notes = [*snapshot.loads, load], snapshot.notes if notes is None else notes
    if not put_json(spark, _manifest(snapshot.table, snapshot.version + 1), {"loads": loads, "notes": notes}, replace=False):
        raise StaleSnapshot(f"{snapshot.table} has a state behind {snapshot.version}; read it again and repeat the load")
    return Snapshot(snapshot.table, snapshot.version + 1, tuple(loads), notes)
