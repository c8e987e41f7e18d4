"""Benchmark passages in documents, found by SimHash over windows as long as the item.

A window is contaminated by an item when the weighted Jaccard similarity of their shingles (five words;
each shingle weighs as often as it occurs) is 0.8 or more.

1. A window that shares no shingle with an item has similarity zero. So the shingles of all documents
   meet those of all items, and only places that share one are followed up. Any window can be slid on to
   the next shared shingle (or to the end of the document) without losing similarity, so windows that
   start there are enough.
2. Each such window of the item's length gets a 64-bit SimHash, as does the item. Fingerprints are cut
   into ``radius + 1`` blocks; two that differ in at most ``radius`` bits agree in a block, so pairs that
   agree in a block of the item they share a shingle with are all pairs within the radius.
3. The exact similarity of these pairs decides.

At similarity 0.8 fingerprints differ by 9.7 of 64 bits on average, with a deviation of 2.9; the radius of
19 leaves out about 3 of 10 000 pairs that lie right at the threshold and practically none above it.

Letters are lowered and other signs than letters and digits are left out before words are formed. Defined
results: NULL or blank items and documents match nothing; an item of fewer than five words is one shingle,
as is every window of its length; a document shorter than an item is one window; rows that share a doc_id
count as one document, items that share a text are all reported; an empty table gives an empty result.
Shingles are known by 64-bit hashes of their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfprice.llm.text import ROW, carried, pairwise, unpacked, words
from shelfprice.plans.joins import is_small
from shelfprice.plans.staging import stage

WIDTH = 5
SIMILARITY = 0.8
RADIUS = 19


def plain_words(text: Column) -> Column:
    return words(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\x20\x09-\x0D]+", ""))


def _grams(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """``keep``, the number of words ``n`` and, per width, the hashes ``g1`` ... ``g5`` of all runs of words."""
    digest = lambda x, y: F.xxhash64(x, y)

    def joined(left: str, shift: int, n: Column) -> Column:
        m = F.greatest(n, F.lit(0))
        return F.zip_with(F.slice(left, 1, m), F.slice("g1", 1 + shift, m), digest)

    n = F.col("n")
    df = df.select(*keep, plain_words(F.col(text)).alias("w"))
    df = df.select(*keep, F.size("w").alias("n"), F.transform("w", lambda w: F.xxhash64(w)).alias("g1"))
    df = df.withColumn("g2", pairwise(F.col("g1"), 1, n, digest))
    df = df.withColumns({"g4": pairwise(F.col("g2"), 2, n - 1, digest), "g3": joined("g2", 2, n - 2)})
    return df.withColumn("g5", joined("g4", 4, n - 4))


def _of_width(width: Column, widths: list[int]) -> Column:
    grams = F.col(f"g{widths[0]}")
    for w in widths[1:]:
        grams = F.when(width == w, F.col(f"g{w}")).otherwise(grams)
    return grams


def simhash(hashes: Column, lane: int) -> Column:
    """Fingerprint of an array of hashes: a bit is set where over half of them have it.

    Bits are counted side by side in lanes of ``lane`` bits, so an array is passed over ``lane`` times.
    """
    per = 64 // lane
    mask = sum(1 << (lane * i) for i in range(per))
    mask = mask - (1 << 64) if mask >= 1 << 63 else mask
    total = F.size(hashes)
    mark = F.lit(0).cast("bigint")
    for j in range(lane):
        counts = F.aggregate(
            hashes, F.lit(0).cast("bigint"), lambda acc, h: acc + F.shiftrightunsigned(h, j).bitwiseAND(F.lit(mask))  # noqa: B023
        )
        # One lane's counts turned into its bits, each at its own place.
        bits = F.transform(
            F.array(counts),
            lambda c: sum(  # noqa: B023
                (
                    F.when(
                        2 * F.shiftrightunsigned(c, lane * i).bitwiseAND(F.lit((1 << lane) - 1)) > total,
                        F.lit(_signed(1 << (lane * i + j))),  # noqa: B023
                    ).otherwise(F.lit(0).cast("bigint"))
                    for i in range(per)
                ),
                F.lit(0).cast("bigint"),
            ),
        )
        mark = mark.bitwiseOR(F.get(bits, F.lit(0)))
    return mark


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(lowest bit, number of bits) of ``radius + 1`` blocks that cover 64 bits evenly."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _in_blocks(df: DataFrame, fp: str, radius: int) -> DataFrame:
    blocks = [
        F.struct(
            F.lit(i).alias("block"), F.shiftrightunsigned(F.col(fp), low).bitwiseAND(F.lit((1 << bits) - 1)).alias("value")
        )
        for i, (low, bits) in enumerate(_blocks(radius))
    ]
    return df.select("*", F.explode(F.array(*blocks)).alias("b")).select("*", "b.*").drop("b")


def _numbered(hashes: Column) -> Column:
    """A multiset as a set: every hash with the number of its occurrence."""
    ordered = F.sort_array(hashes)
    return F.transform(
        F.array(ordered),
        lambda s: F.transform(s, lambda h, i: F.xxhash64(h, i - F.array_position(s, h))),
    )[0]


def _small_or_not(df: DataFrame) -> DataFrame:
    """Broadcast what is measured to be small; let Spark choose otherwise."""
    return F.broadcast(df) if is_small(df) else df


def _items(benchmark: DataFrame, lane: int) -> DataFrame:
    """One row per distinct item text: its hash ``item``, length, width, shingles and fingerprint."""
    grams = _grams(benchmark.select("text"), "text").where("n > 0")
    width = F.least("n", F.lit(WIDTH))
    shingles = _of_width(F.col("width"), list(range(1, WIDTH + 1)))
    grams = grams.withColumn("width", width).withColumn("shingles", shingles)
    grams = grams.select(F.xxhash64("g1").alias("item"), F.col("n").alias("length"), "width", "shingles")
    one = grams.groupBy("item", "length", "width").agg(F.first("shingles").alias("shingles"))
    return one.select("*", simhash(F.col("shingles"), lane).alias("item_fp"), _numbered(F.col("shingles")).alias("item_set"))


def _shingle() -> Column:
    return F.explode(F.array_distinct("shingles")).alias("shingle")


def _places(docs: DataFrame, width: int) -> DataFrame:
    """Every shingle of every document: ``doc_id, n, grams`` and its place ``at`` in ``grams``."""
    grams = _grams(docs.select("doc_id", "text"), "text", "doc_id").select("doc_id", "n", F.col(f"g{width}").alias("grams"))
    # The outer form, as Spark would compute the grams a second time to filter out empty ones.
    return grams.select("doc_id", "n", "grams", F.posexplode_outer("grams").alias("at", "shingle"))


def _start() -> Column:
    return F.greatest(F.least("at", F.col("n") - F.col("length")), F.lit(0)).alias("start")


def _window(width: int) -> Column:
    return F.slice("grams", F.col("start") + 1, F.greatest(F.col("length") - width + 1, F.lit(0))).alias("window")


def _windows_in_place(docs: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """``doc_id, item, start, window``, cut while the document's grams are at hand; nothing is shuffled.

    For items whose shingles were measured to be few enough to broadcast.
    """
    wanted = F.broadcast(items.select("item", "length", _shingle()))
    hits = _places(docs, width).join(wanted, "shingle").select("doc_id", "item", "length", "grams", _start())
    return hits.select("doc_id", "item", "start", _window(width))


def _windows_again(docs: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """The same for any number of items: shingles are shuffled to find the starts, then the documents that
    have any are read once more."""
    wanted = items.select("item", "length", _shingle())
    starts = _places(docs, width).drop("grams").join(wanted, "shingle").select("doc_id", "item", "length", _start())
    starts = stage(starts.distinct(), "window_starts")
    per_doc = starts.groupBy(F.col("doc_id").alias("of")).agg(F.collect_list(F.struct("item", "length", "start")).alias("windows"))
    grams = _grams(docs.select("doc_id", "text"), "text", "doc_id").select("doc_id", F.col(f"g{width}").alias("grams"))
    met = grams.join(per_doc, F.col("doc_id").eqNullSafe(F.col("of")))
    met = met.select("doc_id", "grams", F.explode_outer("windows").alias("x")).select("doc_id", "grams", "x.*")
    return met.select("doc_id", "item", "start", _window(width))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, min_similarity: float = SIMILARITY, radius: int = RADIUS
) -> DataFrame:
    """``doc_id, item_id, start, length, distance, similarity``: the best window per document and item.

    ``start`` counts the document's plain words from 0.
    """
    sizes = _grams(benchmark.select("text"), "text").agg(F.max("n"), F.collect_set(F.least("n", F.lit(WIDTH)))).first()
    lane = 16 if (sizes[0] or 0) < 1 << 16 else 32
    widths = sorted(w for w in sizes[1] if w) or [WIDTH]  # five at most
    items = stage(_items(benchmark, lane), "items")

    windows = None
    for width in widths:
        of_width = items.where(F.col("width") == width)
        some = _windows_in_place(docs, of_width, width) if is_small(of_width.select("item", _shingle())) else _windows_again(docs, of_width, width)
        windows = some if windows is None else windows.unionByName(some)
    windows = windows.where(F.size("window") > 0)
    # Written, so that no window is hashed again for each of its blocks.
    marked = stage(windows.select("*", simhash(F.col("window"), lane).alias("fp")), "windows")

    table = _in_blocks(items.select("item", "item_fp", "item_set", "length"), "item_fp", radius)
    candidates = _in_blocks(marked, "fp", radius).join(_small_or_not(table), ["item", "block", "value"])
    differ = F.col("fp").bitwiseXOR(F.col("item_fp"))
    first = F.lit(None).cast("int")
    for i, (low, bits) in reversed(list(enumerate(_blocks(radius)))):
        mask = F.lit(_signed(((1 << bits) - 1) << low))
        first = F.when(differ.bitwiseAND(mask) == 0, i).otherwise(first)
    # A pair that agrees in several blocks counts in the first of them.
    pairs = candidates.withColumn("distance", F.bit_count(differ)).where((F.col("distance") <= radius) & (first == F.col("block")))
    common = F.size(F.array_intersect(_numbered(F.col("window")), "item_set"))
    similarity = common / (F.size("window") + F.size("item_set") - common)
    scored = pairs.withColumn("similarity", similarity).where(F.col("similarity") >= min_similarity)
    best = F.max_by(
        F.struct("start", "length", "distance", "similarity"), F.struct("similarity", -F.col("start"), -F.col("distance"))
    )
    best = scored.groupBy("doc_id", "item").agg(best.alias("best"))
    named = _grams(benchmark.select("item_id", "text"), "text", "item_id").where("n > 0")
    named = named.select("item_id", F.xxhash64("g1").alias("item"))
    return best.join(named, "item").select("doc_id", "item_id", "best.*")


def keep_clean(docs: DataFrame, benchmark: DataFrame, by_text: bool = False) -> DataFrame:
    """The documents without a benchmark passage, with their own columns.

    With ``by_text`` rows that share a doc_id are documents of their own, known by a hash of the text as well,
    so that a clean text stays beside another one of its id.
    """
    text_hash = F.xxhash64("text") if by_text else F.lit(0).cast("bigint")
    known = docs.select(F.struct("doc_id", text_hash.alias("text_hash")).alias("doc_id"), "text")
    dirty = contaminated(known, benchmark).select(F.col("doc_id.doc_id").alias("dirty_id"), F.col("doc_id.text_hash").alias("dirty_hash"))
    dirty = stage(dirty.distinct(), "contaminated")
    packed = carried(docs, F.col("doc_id").alias("id"), text_hash.alias("hash"))
    same = F.col("id").eqNullSafe(F.col("dirty_id")) & (F.col("hash") == F.col("dirty_hash"))
    return unpacked(packed.join(dirty, same, "left_anti").select(ROW))
