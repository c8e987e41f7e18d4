"""Load new CSV drops into the base table as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfprice.operators.load import (
    apply_contract,
    check_contract,
    coerce_types,
    insert_if_absent,
    load_summary,
    quarantined,
)
from shelfprice.plans.sketches import merged, quantiles_of_sketches, sketches
from shelfprice.plans.staging import delete_matching, staged
from shelfprice.schema import BASE_TYPES, ORDER_KEY
from shelfprice.sources.csv import CSV_FILES, read_raw_csv
from shelfprice.sources.snapshots import commit, file_system, load_folder, read_snapshot
from shelfprice.sources.urls import add_urls, stored_urls

# Files that are read as one batch of rows; a larger backlog is loaded in several.
FILES_PER_LOAD = 10_000
_FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"
# Loads count up; within a load the files go by name, whatever their times.
_ORDER_TYPE = "struct<load:bigint,path:string,row:bigint>"


def _table_schema() -> T.StructType:
    columns = {**BASE_TYPES, ORDER_KEY: _ORDER_TYPE, "created_at": "timestamp_ntz", "load_id": "string"}
    return T.StructType.fromDDL(", ".join(f"{name} {type_}" for name, type_ in columns.items()))


def read_loaded(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The base table written by :func:`load_drops`, as last committed or in an earlier state; empty before the first load."""
    return read_snapshot(spark, table, version).read(spark, "rows", _table_schema())


def read_summary(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """Rows offered, inserted and skipped per load and platform, as :func:`load_drops` wrote them."""
    schema = "platform string, offered bigint, inserted bigint, skipped bigint, load_id string"
    return read_snapshot(spark, table, version).read(spark, "summary", T.StructType.fromDDL(schema))


def approx_price_quantiles(spark: SparkSession, table: str, probs: dict[str, float], version: int | None = None) -> DataFrame:
    """Price quantiles per platform from the sketches that the loads kept; no listing is read."""
    kept = read_snapshot(spark, table, version).read(spark, "sketches", "platform string, n bigint, sketch binary")
    return quantiles_of_sketches(merged(kept, ["platform"]), ["platform"], probs)


def _load_files(spark: SparkSession, paths: list[str], table: str, quarantine: str | None, load_id: str) -> None:
    """One load, committed at its end; a load that is committed already is left as it is."""
    _load_cuts(spark, {load_id: [(path, path) for path in paths]}, table, quarantine)


def _load_cuts(spark: SparkSession, cuts: dict[str, list[tuple[str, str]]], table: str, quarantine: str | None) -> None:
    """Loads that follow each other, worked out in one pass over all their files and then committed one by one.

    ``cuts`` has the files of each load, as path and as the URI that rows name them by. The order key leads with the number of
    the load, so one ranking over all of them finds what loads one after the other would find. Loads that are committed
    already are left as they are.
    """
    snapshot = read_snapshot(spark, table)
    known = {load["load_id"] for load in snapshot.loads}
    cuts = {load_id: files for load_id, files in cuts.items() if load_id not in known}
    if not cuts:
        return
    number = max((load["number"] for load in snapshot.loads), default=-1) + 1
    loads = spark.createDataFrame(list(enumerate(cuts, number)), "load bigint, load_id string")
    paths = [path for files in cuts.values() for path, _ in files]
    # The text files are parsed and checked once; counting and inserting read the staged rows.
    parsed = coerce_types(_numbered(read_raw_csv(spark, paths), list(cuts.values()), number), note_not_finite=True)
    with staged(check_contract(parsed), "drops") as raw:
        batch = apply_contract(raw, "quarantine" if quarantine else "fail")
        fresh = insert_if_absent(batch, stored_urls(spark, snapshot, batch)).withColumn("created_at", F.localtimestamp())

        def write(df: DataFrame, folder: str) -> None:
            """Rows by load, of which they have the number; loads without rows get no folder."""
            if len(cuts) == 1:
                df.drop("load").write.mode("overwrite").parquet(f"{folder}/load_id={next(iter(cuts))}")
            else:
                named = df.join(F.broadcast(loads), "load").drop("load")
                named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(folder)

        load = F.col(f"{ORDER_KEY}.load").alias("load")
        write(fresh.select("*", load), f"{snapshot.table}/rows")
        if quarantine:
            where = F.struct(f"{ORDER_KEY}.path", f"{ORDER_KEY}.row").alias(ORDER_KEY)
            bad = quarantined(raw)
            write(bad.select(*[where if c == ORDER_KEY else c for c in bad.columns], load), quarantine)
        written = _written(spark, snapshot.table, "rows", list(cuts))
        inserted = snapshot.read(spark, "rows", fresh.schema, [load_folder(snapshot.table, "rows", i) for i in written])
        result = load_summary(batch.select("*", load), inserted.select("*", load), inserted.select("*", load).limit(0), ["load", "platform"])
        write(result.coalesce(1), f"{snapshot.table}/summary")
        write(sketches(inserted.select("*", load), ["load", "platform"], "current_price").coalesce(1), f"{snapshot.table}/sketches")
        has = {part: set(_written(spark, snapshot.table, part, list(cuts))) for part in ("rows", "summary", "sketches")}
        for at, (load_id, files) in enumerate(cuts.items()):
            # Each state has the URLs of its own loads, so that a retry behind it finds those of the others new.
            own = [load_folder(snapshot.table, "rows", load_id)] if load_id in has["rows"] else []
            urls = snapshot.read(spark, "rows", "product_url string", own).select("product_url")
            index, notes = add_urls(spark, snapshot, load_id, urls.where(F.col("product_url").isNotNull()))
            parts = [part for part in has if load_id in has[part]] + ["urls"]
            load = {"load_id": load_id, "number": number + at, "parts": parts, "files": len(files), "last_path": files[-1][0], **index}
            snapshot = commit(spark, snapshot, load, {**snapshot.notes, **notes})


def _numbered(raw: DataFrame, cuts: list[list[tuple[str, str]]], number: int) -> DataFrame:
    """Rows with the number of their load before the file and row in the order key."""
    if len(cuts) == 1:
        load = F.lit(number).cast("bigint")
    else:
        files = [(uri, at) for at, files in enumerate(cuts, number) for _, uri in files]
        found = raw.sparkSession.createDataFrame(files, "_uri string, _load bigint")
        raw = raw.join(F.broadcast(found), F.col(f"{ORDER_KEY}.path") == F.col("_uri"), "left")
        load = F.coalesce("_load", F.raise_error(F.lit("row of a file that is in no load")).cast("bigint"))
    key = F.struct(load.alias("load"), f"{ORDER_KEY}.path", f"{ORDER_KEY}.row")
    return raw.withColumn(ORDER_KEY, key).drop("_uri", "_load")


def _written(spark: SparkSession, table: str, part: str, load_ids: list[str]) -> list[str]:
    """Those of the loads that have written a folder of this part."""
    root, system = file_system(spark, f"{table}/{part}")
    names = {status.getPath().getName() for status in system.listStatus(root)} if system.exists(root) else set()
    return [load_id for load_id in load_ids if f"load_id={load_id}" in names]


def load_drops(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    quarantine: str | None = None,
    files_per_load: int = FILES_PER_LOAD,
) -> StreamingQuery:
    """Load the CSV files below ``landing`` that no earlier run of this checkpoint has loaded.

    The stream carries file names only. All waiting files are one batch and go by name; cut into loads
    of ``files_per_load``, they are read header-bound, checked and inserted where their URLs are new. As
    the cuts follow the order by which the first row of a URL wins, they do not change what is loaded. A
    load writes directories of its own (rows, quarantine, summary). Loads of up to ``FILES_PER_LOAD`` files in all are worked out
    together, so that few files a load do not leave most cores idle, and committed one by one by a manifest each; readers see
    committed loads only. A retried batch goes on behind its committed loads and first removes what the others left, so loading is
    exactly-once. Of two writers that load at the same time the later one is refused and may repeat its load.
    Without a ``quarantine`` folder a row that breaks the contract fails the load; each load then is worked out and committed by
    itself, so that those before it stay.
    """

    def load_batch(files: DataFrame, batch_id: int) -> None:
        session = files.sparkSession
        waiting = sorted((row.path, row.uri) for row in files.select("path", "uri").collect())
        batch = f"{session.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id:06d}"
        done = [load for load in read_snapshot(session, table).loads if load["load_id"].startswith(f"{batch}-")]
        committed = {f"load_id={load['load_id']}" for load in done}
        for folder in filter(None, (*(f"{table}/{part}" for part in ("rows", "urls", "summary", "sketches")), quarantine)):
            delete_matching(session, f"{folder}/load_id={batch}-*", keep=committed)
        if done:
            waiting = [file for file in waiting if file[0] > done[-1]["last_path"]]
        cuts = {}
        for number, at in enumerate(range(0, len(waiting), files_per_load), len(done)):
            cuts[f"{batch}-{number:06d}"] = waiting[at : at + files_per_load]
        together = max(1, FILES_PER_LOAD // files_per_load) if quarantine else 1
        for at in range(0, len(cuts), together):
            _load_cuts(session, dict(list(cuts.items())[at : at + together]), table, quarantine)

    files = spark.readStream.format("binaryFile").schema(_FILE_SCHEMA).options(**CSV_FILES).load(landing)
    files = files.select("path", F.col("_metadata.file_path").alias("uri"))
    return (
        files.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
