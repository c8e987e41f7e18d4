"""Which URLs a table holds, so that a load reads what its own URLs may meet and nothing else.

Beside its rows every load writes its URLs twice: in folders by bucket of a hash, as many as its size asks for, and as bits of a
Bloom filter. The filter is a table of bitmaps, and a URL sets ``PROBES`` bits in one of them. A batch first meets the bitmaps,
two bytes per stored URL; URLs that are not all set there are new for certain. The few others are looked up in the buckets they
fall into. The bitmaps have room for a number of URLs; when a load goes beyond it they are built anew, four times as many,
so that rebuilding costs a constant part of all loads. A table of few URLs, as its manifest counts them, is read whole instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfprice.plans.joins import BROADCAST_ROWS, attach_groups, is_small
from shelfprice.plans.staging import stage
from shelfprice.sources.snapshots import Snapshot, load_folder

# URLs of a load that share a bucket, and the most buckets of a load; numbers of buckets are powers of two.
URLS_PER_BUCKET = 50_000
MOST_BUCKETS = 4096
# Up to so many stored URLs a batch meets them all.
READ_WHOLE = 100_000
PROBES = 8
# Bits of a bitmap as Spark builds them, and URLs that share one: 16 bits each, so 1 of 1700 new URLs is looked up.
PIECE_BITS = 32_768
URLS_PER_PIECE = 2048
LEAST_PIECES = 16
GROWTH = 4

_URLS = "product_url string, bucket int"
_BITS = "piece int, bits binary"


def _bucket(url: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(buckets)).cast("int")


def _paths(snapshot: Snapshot, fine: set[int]) -> list[str]:
    """Folders of all loads that may hold a URL with one of these buckets out of ``MOST_BUCKETS``."""
    out = []
    for load in snapshot.loads:
        if "urls" in load["parts"]:
            folder = load_folder(snapshot.table, "urls", load["load_id"])
            hit = {bucket % load["buckets"] for bucket in fine} & set(load["filled"])
            out += [f"{folder}/bucket={bucket}" for bucket in sorted(hit)]
    return out


def _piece(url: Column, pieces: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("piece"), url), F.lit(pieces)).cast("int")


def _positions(url: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(probe), url), F.lit(PIECE_BITS)) for probe in range(PROBES)]


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), (position % 8).cast("int")) == 1


def bitmaps(urls: DataFrame, pieces: int) -> DataFrame:
    """``piece, bits`` of the URLs, combined on the map side."""
    url = F.col("product_url")
    probes = urls.select(_piece(url, pieces).alias("piece"), F.explode(F.array(*_positions(url))).alias("position"))
    return probes.groupBy("piece").agg(F.bitmap_construct_agg("position").alias("bits"))


def possibly_in(urls: DataFrame, filters: DataFrame, pieces: int) -> DataFrame:
    """The URLs all of whose bits are set: all that are stored, and a few that are not."""
    whole = filters.groupBy("piece").agg(F.bitmap_or_agg("bits").alias("bits"))
    url = F.col("product_url")
    met = attach_groups(urls.withColumn("piece", _piece(url, pieces)), whole, ["piece"], how="inner")
    hit = reduce(lambda a, b: a & b, [_is_set(F.col("bits"), p) for p in _positions(url)])
    return met.where(hit).select("product_url")


def stored_urls(
    spark: SparkSession, snapshot: Snapshot, batch: DataFrame, max_broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``product_url`` of those URLs of a batch that the table holds, each once."""
    filters = snapshot.notes.get("filters")
    if not filters:
        return spark.createDataFrame([], "product_url string")
    if filters["urls"] <= READ_WHOLE:
        return snapshot.read(spark, "urls", _URLS).select("product_url")
    folders = [load_folder(snapshot.table, filters["part"], load) for load in filters["loads"]]
    bits = snapshot.read(spark, filters["part"], _BITS, folders)
    asked = batch.select("product_url").where(F.col("product_url").isNotNull())
    maybe = stage(possibly_in(asked, bits, filters["pieces"]).distinct(), "possible_urls")
    fine = maybe.select(_bucket(F.col("product_url"), MOST_BUCKETS).alias("bucket")).distinct()
    paths = _paths(snapshot, {r.bucket for r in fine.collect()})  # no more than MOST_BUCKETS numbers
    if not paths:
        return maybe.limit(0)
    stored = snapshot.read(spark, "urls", _URLS, paths).select("product_url")
    return stored.join(F.broadcast(maybe) if is_small(maybe, max_broadcast_rows) else maybe, "product_url", "left_semi")


def add_urls(spark: SparkSession, snapshot: Snapshot, load_id: str, urls: DataFrame) -> tuple[dict, dict]:
    """Write the URLs of a load (each new, not NULL, cheap to read) by bucket, and its bits.

    Returns what to commit: entries of the load, and of the table's notes.
    """
    url = F.col("product_url")
    n, fine = urls.agg(F.count(F.lit(1)), F.collect_set(_bucket(url, MOST_BUCKETS))).first()
    buckets = 1
    while buckets < MOST_BUCKETS and buckets * URLS_PER_BUCKET < n:
        buckets *= 2
    by_bucket = urls.select("product_url", _bucket(url, buckets).alias("bucket"))
    by_bucket = by_bucket.repartition("bucket").sortWithinPartitions("bucket", "product_url") if buckets > 1 else by_bucket.coalesce(1)
    by_bucket.write.mode("overwrite").partitionBy("bucket").parquet(load_folder(snapshot.table, "urls", load_id))
    before = snapshot.notes.get("filters") or {"urls": 0, "pieces": 0, "loads": []}
    total = before["urls"] + n
    pieces, loads, part = before["pieces"], [*before["loads"], load_id], before.get("part")
    if total > pieces * URLS_PER_PIECE:
        pieces = max(pieces, LEAST_PIECES)
        while total > pieces * URLS_PER_PIECE // 2:
            pieces *= GROWTH
        # Another part, as states before this one go on with their own filters.
        loads, part = [load_id], f"filters_{pieces}"
        urls = urls.select("product_url").unionByName(snapshot.read(spark, "urls", _URLS).select("product_url"))
    bitmaps(urls, pieces).write.mode("overwrite").parquet(load_folder(snapshot.table, part, load_id))
    filled = sorted({bucket % buckets for bucket in fine})
    return {"buckets": buckets, "filled": filled}, {"filters": {"urls": total, "pieces": pieces, "loads": loads, "part": part}}
