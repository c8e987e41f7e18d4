"""SimHash near-duplicates by multi-index hashing.

A fingerprint has a bit set where more than half the hashes of the text's word shingles have it. Texts
whose fingerprints differ in at most three bits are linked, and a component of links is a group of copies.

Search: a fingerprint is cut into two segments of 32 bits. Fingerprints within three bits differ by at
most one bit in one of the segments. So each fingerprint looks up, per segment, its own value and every
value one bit away, and whole distances are verified inside the join. Of two values one bit apart exactly
one has a 0 there, so only 0 to 1 is looked up: 17 look-ups per segment on average.

Equal fingerprints are one node from the start, so exact copies cost nothing. A segment value that more
than ``HOT`` fingerprints share (near copies of one text that differ only in the other segment) is looked
up together with a part of that other segment in the same way: of its two halves, one differs by at most
one bit. No candidate is dropped anywhere.

Defined results: NULL, empty and blank texts have fingerprint zero and are linked like any other; fewer
words than a shingle has are one shingle; repeated rows fall in one group; NULL ids are never the smallest
of a group unless it has no other; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfprice.llm.components import connected_components
from shelfprice.llm.text import ROW, carried, unpacked
from shelfprice.plans.staging import stage

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
# Share of one segment value from which on a part of the other segment joins the key.
HOT = 256
# Shingles whose bits are unpacked at once: 64 bytes each.
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a UTF-8 text, as a signed integer."""
    parts = (text or b"").lower().split()  # bytes: only A-Z are lowered, only ASCII white space parts words
    if not parts:
        return 0
    k = min(shingle_words, len(parts))
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first, last = starts[: len(parts) - k + 1].tolist(), ends[k - 1 :].tolist()
    digest = xxhash.xxh64_digest
    n = len(first)
    set_ = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        cuts = zip(first[at : at + _CHUNK], last[at : at + _CHUNK], strict=True)
        raw = b"".join([digest(joined[a:b], SEED) for a, b in cuts])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(-1, 64)
        set_ += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_ > n).view(">i8")[0])


def _fingerprinter(shingle_words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            marks = [fingerprint(t.as_py(), shingle_words) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks, pa.int64())], ["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp`` per document."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_fingerprinter(shingle_words), f"doc_id {id_type}, fp bigint")


def _part(value: Column, low_bit: int, bits: int) -> Column:
    return F.shiftrightunsigned(value, low_bit).bitwiseAND(F.lit((1 << bits) - 1))


def _flips(bits: int) -> Column:
    """0, which looks up the value itself, and each single bit."""
    return F.explode(F.array(*[F.lit(x) for x in [0, *(1 << b for b in range(bits))]]).cast("array<bigint>"))


def links(marks: DataFrame, max_distance: int = MAX_DISTANCE, hot: int = HOT) -> DataFrame:
    """``a, b``: pairs of distinct fingerprints (column ``fp``) within the distance; a pair may come twice."""
    if not 2 <= max_distance <= 3:
        raise ValueError("two segments with balls of one bit serve distances 2 and 3")
    segments = F.explode(
        F.array(
            F.struct(F.lit(0).alias("segment"), _part(F.col("fp"), 0, 32).alias("key"), _part(F.col("fp"), 32, 32).alias("other")),
            F.struct(F.lit(1).alias("segment"), _part(F.col("fp"), 32, 32).alias("key"), _part(F.col("fp"), 0, 32).alias("other")),
        )
    )
    index = stage(marks.select("fp", segments.alias("s")).select("fp", "s.*"), "simhash_index")
    flip = index.select("fp", "segment", "key", "other", _flips(32).alias("flip")).where("(key & flip) = 0")
    probes = flip.select(
        F.col("fp").alias("a"), "segment", F.expr("key | flip").alias("key"), F.col("other").alias("a_other"), "flip"
    )
    table = index.withColumnsRenamed({"fp": "b", "other": "b_other"})
    near = (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance) & ((F.col("flip") != 0) | (F.col("a") < F.col("b")))
    shared = stage(index.groupBy("segment", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot), "simhash_hot")
    on = ["segment", "key"]
    if shared.isEmpty():
        return _matches(probes, table, on, near)
    shared = shared.select(*on)
    cold = _matches(probes.join(shared, on, "left_anti"), table.join(shared, on, "left_anti"), on, near)
    halves = lambda other: F.explode(
        F.array(*[F.struct(F.lit(h).alias("half"), _part(F.col(other), 16 * h, 16).alias("sub")) for h in (0, 1)])
    )
    hot_table = table.join(shared, on, "left_semi").select("*", halves("b_other").alias("h")).select("*", "h.*").drop("h")
    hot_probes = probes.join(shared, on, "left_semi").select("*", halves("a_other").alias("h")).select("*", "h.*")
    hot_probes = hot_probes.drop("h").select("*", _flips(16).alias("sub_flip"))
    hot_probes = hot_probes.withColumn("sub", F.expr("sub ^ sub_flip")).drop("sub_flip")
    return cold.unionByName(_matches(hot_probes, hot_table, [*on, "half", "sub"], near))


def _matches(probes: DataFrame, table: DataFrame, on: list[str], near: Column) -> DataFrame:
    p, t = probes.alias("p"), table.alias("t")
    same = [F.col(f"p.{c}") == F.col(f"t.{c}") for c in on]
    condition = near
    for s in same:
        condition = condition & s
    return p.join(t, condition).select("a", "b")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id`` (the smallest id of its group)."""
    marks = stage(fingerprints(docs, shingle_words), "simhash_marks")
    return _grouped(marks, F.min("doc_id"), max_distance)


def _grouped(marks: DataFrame, least: Column, max_distance: int) -> DataFrame:
    """``marks`` with ``component_id``, the least of the group by the aggregate ``least`` of a fingerprint's rows."""
    distinct = stage(marks.groupBy("fp").agg(least.alias("first")), "simhash_distinct")
    roots = connected_components(links(distinct.select("fp"), max_distance).distinct())
    of = roots.select(F.col("node").alias("fp"), "root")
    rooted = stage(distinct.join(of, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "simhash_roots")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = stage(rooted.join(least, "root").select("fp", "component_id"), "simhash_groups")
    return marks.join(groups, "fp")


def keep_first(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One document of each group, that with the smallest id (NULL last), with its own columns.

    Rows are known by id and a hash of the text, so unlike texts that share an id are documents of their own;
    of one id in a group the least hash is kept, and of rows that agree in both one. Documents meet those that
    go, which are fewer than those that stay, and rows are grouped only where id and text repeat.
    """
    known = F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("doc_id")
    marks = stage(fingerprints(docs.select(known, "text"), shingle_words).select("doc_id.*", "fp"), "simhash_marks")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    groups = _grouped(marks, F.min(order), max_distance).withColumn("stays", order == F.col("component_id"))
    groups = stage(groups.select("doc_id", "text_hash", "stays"), "simhash_components")
    rows = groups.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"), F.bool_and("stays").alias("stays"))
    apart = rows.where("rows > 1 OR NOT stays").select(F.col("doc_id").alias("other_id"), F.col("text_hash").alias("other_hash"), "stays")
    apart = stage(apart, "simhash_apart")
    packed = carried(docs, F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    same = F.col("id").eqNullSafe(F.col("other_id")) & (F.col("hash") == F.col("other_hash"))
    kept = packed.join(apart, same, "left_anti").select(ROW)
    repeated = apart.where("stays")
    if not repeated.isEmpty():
        # Rows of one id and text meet here; each map task sends one at most.
        first = F.min_by(ROW, F.xxhash64(F.to_json(ROW))).alias(ROW)
        kept = kept.unionByName(packed.join(repeated, same, "left_semi").groupBy("id", "hash").agg(first).select(ROW))
    return unpacked(kept)
