"""Passages that repeat anywhere in the corpus are kept once: lines or paragraphs, and runs of words inside them.

A text is cut into units at line feeds (or at blank lines). A unit is normalised (A-Z lowered, white space
runs made one space) and known by a 128-bit digest. All digests are grouped; of the occurrences of a digest
the earliest stays, by document id and place in the document, and all others are removed, within a document
as well as across documents. What is removed is reported with its offsets in the original text. Whole texts
are units too, so that a copy of a document needs no further look.

Units of fewer than ``min_words`` words stay: lines of a few words are equal by chance or stock phrases, and cutting them
would spoil documents that have nothing else in common. ``repeated_units`` reports them.

A passage need not be a whole line. So with ``window`` words given, every run of that many words is a unit as well, across line feeds.
Digests of all runs would be many times the corpus, so anchors say first where to look: each text gives the hashes of
short word grams that are the least of their neighbourhood. That choice depends on the words alone, and every run of ``window``
words holds at least one gram so chosen, so two equal runs share it at the same place: no repeated run is missed.
A shared anchor first gets one digest of its surroundings, the words of all runs that hold it: where these repeat an earlier place, so
does every such run, and one row has settled them all. Only the runs around the other shared anchors get digests of their own.
All digests are grouped as those of units are. Of a run that overlaps its own earliest
occurrence (a word said over and over) nothing is removed, so the first ``window`` words stay.

A removed word takes the white space before it in its unit along; a unit that loses all its words goes with its separator.

Only places (no texts) are grouped; counts and minima are combined on the map side, and joins back have one row per
digest on one side, so that the occurrences of a very common line can be split.

Defined results: a NULL text stays NULL and has no units; of two documents with one id the one read first (as the rows were
numbered) comes first, also if they agree in all columns; NULL ids come first; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from shelfprice.plans.joins import attach_groups, is_small
from shelfprice.plans.staging import stage

# A run of so many words is a passage; units that are shorter stay.
PASSAGE = 50
# Shorter units are not even reported.
MIN_WORDS = 5
LINE = r"\n"
PARAGRAPH = r"\n[\x20\x09-\x0D]*\n"

# Words of an anchor; the neighbourhood follows from the window.
GRAM = 12
# Different words whose hashes a task remembers.
KNOWN_WORDS = 100_000
# Rows that a task works on at a time, whatever the batch it gets.
ROWS_AT_A_TIME = 1000
TEXT, UNIT, ANCHOR = 0, 1, 2
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Odd multipliers of the two polynomial hashes, and of the mixing step behind them.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = 0xD6E8FEB86659FD93


def units(text: str, separator: str) -> Iterator[tuple[int, int]]:
    """Start and end of the units of a text."""
    at = 0
    for cut in re.finditer(separator, text):
        yield at, cut.start()
        at = cut.end()
    yield at, len(text)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_A_TIME):
            yield batch.slice(start, ROWS_AT_A_TIME)


class WordHashes(dict):
    """XXH64 of words, remembered up to a number of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_MIX)
    return x ^ (x >> np.uint64(29))


class RunHashes:
    """Hashes of any runs of words: differences of the sums of ``word * base ** place``, moved to place zero."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.powers = self.inverses = np.empty(0, np.uint64)

    def _reach(self, n: int) -> None:
        if n > len(self.powers):
            size = max(n, 2 * len(self.powers), 4096)
            self.powers, self.inverses = self._powers(self.base, size), self._powers(self.inverse, size)

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    def sums(self, words: np.ndarray) -> np.ndarray:
        self._reach(len(words) + 1)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self.powers[: len(words)], dtype=np.uint64)])

    def runs(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((sums[end] - sums[start]) * self.inverses[start])

    def all_runs(self, words: np.ndarray, length: int) -> np.ndarray:
        sums = self.sums(words)
        found = sums[length:] - sums[:-length]
        found *= self.inverses[: len(found)]
        return _mixed(found)


class Digests:
    """128-bit digests of runs of the words of one text."""

    def __init__(self):
        self.known, self.hashes = WordHashes(), tuple(map(RunHashes, _BASES))

    def of(self, words: list[bytes]) -> np.ndarray:
        return self.known.array(words)

    def runs(self, words: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        seen = (words, _mixed(words))
        return [h.runs(h.sums(w), start, end).view(np.int64) for h, w in zip(self.hashes, seen, strict=True)]


def _sliding(values: np.ndarray, width: int, best: Callable) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``width`` neighbours."""
    out, size = values, 1
    while size * 2 <= width:
        out = best(out[:-size], out[size:])
        size *= 2
    return out if size == width else best(out[: len(out) - (width - size)], out[width - size :])


def anchors(words: np.ndarray, window: int, gram: int, hashes: RunHashes) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the grams that are the least in some run of ``window`` words."""
    width = window - gram + 1
    if len(words) < window:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = hashes.all_runs(words, gram)
    least = _sliding(grams, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    at = np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), width, np.maximum) == grams)
    return at, grams[at]


def _normal(text: str) -> list[bytes]:
    return text.encode().lower().split()


def _digest(words: list[bytes]) -> tuple[int, int]:
    return tuple(np.frombuffer(hashlib.blake2b(b" ".join(words), digest_size=16).digest(), np.int64))


def _scanner(separator: str, min_words: int, window: int | None, gram: int) -> Callable:
    """Digests of whole texts and units with their places, and anchors."""
    names = ["row", "doc_id", "kind", "at", "start", "end", "d1", "d2"]

    def cut(text: str) -> Iterator[tuple[int, int, list[bytes]]]:
        for start, end in units(text, separator):
            yield start, end, _normal(text[start:end])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = Digests()
        for batch in _slices(batches):
            found, where = [], []
            for number, text in enumerate(batch.column("text")):
                text = text.as_py()
                if text is None:
                    continue
                words = []
                for unit, (start, end, mine) in enumerate(cut(text)):
                    words += mine
                    if len(mine) >= min_words:
                        found.append((number, UNIT, unit, start, end, *_digest(mine)))
                if window is not None and len(words) >= window:
                    found.append((number, TEXT, 0, 0, len(text), *_digest(words)))
                    where.append((number, *anchors(digests.of(words), window, gram, digests.hashes[0])))
            of, kind, at, start, end, d1, d2 = (list(c) for c in zip(*found, strict=True)) if found else ([] for _ in range(7))
            sizes = [len(places) for _, places, _ in where]
            more = sum(sizes)
            zeros = np.zeros(more, np.int32)
            of = np.concatenate([np.array(of, np.int32), np.repeat(np.array([n for n, _, _ in where], np.int32), sizes)])
            columns = [
                np.concatenate([np.array(kind, np.int8), np.full(more, ANCHOR, np.int8)]),
                np.concatenate([np.array(at, np.int32), *[places.astype(np.int32) for _, places, _ in where]]),
                *(np.concatenate([np.array(x, np.int32), zeros]) for x in (start, end)),
                np.concatenate([np.array(d1, np.int64), *[hashes.view(np.int64) for _, _, hashes in where]]),
                np.concatenate([np.array(d2, np.int64), zeros.astype(np.int64)]),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(of)) for c in names[:2]), *map(pa.array, columns)], names=names)

    return run


def _near(places: np.ndarray, reach: int, behind: int, n: int) -> np.ndarray:
    """All numbers from ``reach`` before a place to ``behind`` after it that lie in 0 .. n - 1."""
    marks = np.zeros(n + 1, np.int32)
    np.add.at(marks, np.clip(places - reach, 0, n), 1)
    np.add.at(marks, np.clip(places + behind + 1, 0, n), -1)
    return np.flatnonzero(np.cumsum(marks[:-1]) > 0)


def _runs_of_texts(select: Callable) -> Callable:
    """Digests of the runs that ``select`` names: it maps the places given with a text, and its number of words, to
    places, starts and ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = Digests()
        for batch in _slices(batches):
            given = [batch.column(c) for c in batch.schema.names[3:]]
            for number, (text, *places) in enumerate(zip(batch.column("text"), *given, strict=True)):
                words = digests.of(_normal(text.as_py()))
                places = [np.array(p.as_py().split(","), np.int64) if p.as_py() else np.empty(0, np.int64) for p in places]
                at, start, end = select(len(words), *places)
                of = pa.array(np.full(len(at), number, np.int32))
                columns = [x.astype(np.int32) for x in (at, start, end)] + digests.runs(words, start, end)
                own = [batch.column(c).take(of) for c in ("row", "doc_id")]
                yield pa.RecordBatch.from_arrays([*own, *map(pa.array, columns)], names=["row", "doc_id", "at", "start", "end", "d1", "d2"])

    return run


def _surroundings(window: int, gram: int) -> Callable:
    """Around each anchor the words of all windows that hold it."""

    def select(n: int, places: np.ndarray) -> tuple[np.ndarray, ...]:
        return places, np.maximum(places - (window - gram), 0), np.minimum(places + window, n)

    return select


def _windows(window: int, gram: int) -> Callable:
    """The windows that hold an open anchor and no settled one."""

    def select(n: int, open_: np.ndarray, settled: np.ndarray) -> tuple[np.ndarray, ...]:
        near = [_near(places, window - gram, 0, n - window + 1) for places in (open_, settled)]
        at = np.setdiff1d(*near, assume_unique=True)
        return at, at, at + window

    return select


def removed_spans(text: str, numbers: set[int], runs: list[tuple[int, int]], whole: bool, separator: str) -> list[tuple[int, int, int]]:
    """``(unit, start, end)`` of what goes: units by number, and words by place (first word and number of words)."""
    cut = list(units(text, separator))
    found = [list(_WORD.finditer(text, start, end)) for start, end in cut]
    gone = np.full(sum(map(len, found)), whole)
    for first, n in runs:
        gone[first : first + n] = True
    spans, first = [], 0
    for number, ((start, end), words) in enumerate(zip(cut, found, strict=True)):
        mine = gone[first : first + len(words)]
        first += len(words)
        if number in numbers or (words and mine.all()):
            spans.append((number, start, end))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
        spans += [(number, words[a].start(), words[b - 1].end()) for a, b in zip(edges[::2], edges[1::2], strict=True)]
    return spans


def without(text: str, spans: list[tuple[int, int, int]], separator: str) -> str:
    """The text without these spans; a unit that stays keeps the separator before it."""
    per_unit: dict[int, list[tuple[int, int]]] = {}
    for number, start, end in spans:
        per_unit.setdefault(number, []).append((start, end))
    out, before = [], 0
    for number, (start, end) in enumerate(units(text, separator)):
        cuts = per_unit.get(number, [])
        if cuts != [(start, end)]:
            if out:
                out.append(text[before:start])
            at, kept = start, ""
            for a, b in cuts:
                # White space of a text is more than that of this operator, so it is named.
                kept += text[at:a].rstrip(" \t\n\v\f\r")
                at = b
            out.append(kept + text[at:end])
        before = end
    return "".join(out)


_REMOVED = T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in ("unit", "start", "end")]))


def _remover(separator: str) -> Callable:
    kind = pa.list_(pa.struct([(c, pa.int32()) for c in ("unit", "start", "end")]))

    def parsed(text: str | None) -> list[tuple[int, int]]:
        return [tuple(map(int, x.split("+"))) for x in text.split(",")] if text else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts, removed = [], []
            given = [batch.column(c) for c in ("text", "units", "runs", "whole")]
            for text, numbers, runs, whole in zip(*given, strict=True):
                text, numbers, runs, whole = text.as_py(), numbers.as_py(), parsed(runs.as_py()), whole.as_py()
                spans = []
                if text is not None and (numbers or runs or whole):
                    spans = removed_spans(text, set(map(int, numbers.split(","))) if numbers else set(), runs, bool(whole), separator)
                    text = without(text, spans, separator)
                texts.append(text)
                removed.append([dict(zip(("unit", "start", "end"), s, strict=True)) for s in spans])
            columns = [batch.column("rest"), pa.array(texts, pa.string()), pa.array(removed, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["rest", "text", "removed"])

    return run


def _shared(places: DataFrame, by: list[str], name: str) -> DataFrame:
    """The places whose digest occurs more than once; most do not, and leave by their counts."""
    counts = places.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    common = stage(counts.where("n > 1").drop("n"), f"{name}_common")
    return stage(places.join(common, by, "left_semi"), f"{name}_shared")


def _later(places: DataFrame, by: list[str], name: str) -> DataFrame:
    """Places whose digest occurs earlier, with the place of the earliest as ``first``."""
    shared = _shared(places, by, name)
    place = F.struct("doc_id", "row", "at")
    first = stage(shared.groupBy(*by).agg(F.min(place).alias("first")), f"{name}_first")
    return shared.join(first, by).where(place != F.col("first"))


def _without(places: DataFrame, rows: DataFrame) -> DataFrame:
    """The places in other rows than these (staged, each once)."""
    return places.join(F.broadcast(rows) if is_small(rows) else rows, "row", "left_anti")


def _numbered(docs: DataFrame) -> DataFrame:
    """All rows (``rest`` has their other columns) with a number that is written with them, so that it never changes."""
    rest = F.struct(*[docs[f"`{c}`"] for c in docs.columns if c != "text"]).alias("rest")
    return stage(docs.select(rest, docs["doc_id"], docs["text"], F.monotonically_increasing_id().alias("row")), "numbered")


def _scanned(numbered: DataFrame, separator: str, min_words: int, window: int | None, gram: int) -> DataFrame:
    """Places of units, texts and anchors."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    added = T.StructType.fromDDL("kind tinyint, at int, start int, end int, d1 bigint, d2 bigint")
    given = numbered.select("row", "doc_id", "text")
    found = given.mapInArrow(_scanner(separator, min_words, window, gram), T.StructType([*given.schema[:2], *added]))
    return stage(found, "places")


def _joined(values: Column) -> Column:
    return F.array_join(F.collect_list(values.cast("string")), ",")


def _digested(numbered: DataFrame, places: DataFrame, select: Callable, name: str) -> DataFrame:
    """Digests of runs in the texts of ``places`` (by row, lists of places as text)."""
    texts = attach_groups(numbered.select("row", "doc_id", "text"), places, ["row"], how="inner")
    added = T.StructType.fromDDL("at int, start int, end int, d1 bigint, d2 bigint")
    return stage(texts.mapInArrow(_runs_of_texts(select), T.StructType([*texts.schema[:2], *added])), name)


def _later_runs(numbered: DataFrame, found: DataFrame, window: int, gram: int) -> DataFrame:
    """``row, runs``: the words of each text that lie in repeated runs, as text such as ``12+50,80+64``."""
    overlaps = (F.col("first.row") == F.col("row")) & (F.col("at") < F.col("first.at") + window)
    shared = _shared(found.select("row", "at", "d1"), ["d1"], "anchors")
    places = shared.groupBy("row").agg(_joined(F.col("at")).alias("anchors"))
    around = _digested(numbered, places, _surroundings(window, gram), "surroundings")
    settled = stage(_later(around, ["d1", "d2"], "surroundings").where(~overlaps).select("row", "at", "start", "end"), "settled")

    is_settled = settled.select("row", "at", F.lit(True).alias("settled"))
    told = around.select("row", "at").join(is_settled, ["row", "at"], "left").groupBy("row")
    places = told.agg(
        _joined(F.when(F.col("settled").isNull(), F.col("at"))).alias("open"), _joined(F.when(F.col("settled"), F.col("at"))).alias("settled")
    ).where("open != ''")
    windows = _digested(numbered, places, _windows(window, gram), "windows")
    later = _later(windows.select("row", "doc_id", "at", "d1", "d2"), ["d1", "d2"], "windows").where(~overlaps)
    # Neighbours lie at one distance from their rank: a run of windows is one group.
    rank = F.row_number().over(Window.partitionBy("row").orderBy("at"))
    runs = later.withColumn("island", F.col("at") - rank).groupBy("row", "island").agg(F.min("at").alias("start"), (F.max("at") + window).alias("end"))
    runs = runs.select("row", "start", "end").unionByName(settled.select("row", "start", "end"))
    run = F.concat_ws("+", F.col("start").cast("string"), (F.col("end") - F.col("start")).cast("string"))
    return runs.groupBy("row").agg(_joined(run).alias("runs"))


def _changes(numbered: DataFrame, separator: str, min_words: int, window: int | None, gram: int) -> DataFrame:
    """``row`` of the texts that lose something: ``units`` and ``runs`` to remove, or the ``whole`` text."""
    places = _scanned(numbered, separator, min_words, window, gram)
    marks = places.where(F.col("kind") < ANCHOR).select("row", "doc_id", "kind", "at", "d1", "d2")
    later = stage(_later(marks, ["kind", "d1", "d2"], "units").select("row", "kind", "at"), "later_units")
    copies = later.where(F.col("kind") == TEXT).select("row")
    lines = _without(later.where(F.col("kind") == UNIT), copies).groupBy("row").agg(_joined(F.col("at")).alias("units"))
    none = F.lit(None).cast("string")
    parts = lines.select("row", "units", none.alias("runs"), F.lit(False).alias("whole"))
    if window is not None:
        parts = parts.unionByName(copies.select("row", none.alias("units"), none.alias("runs"), F.lit(True).alias("whole")))
        # A copy repeats only what its earliest has, so it is not looked into.
        rest = _without(places.where(F.col("kind") == ANCHOR), copies)
        runs = _later_runs(numbered, rest, window, gram)
        parts = parts.unionByName(runs.select("row", none.alias("units"), "runs", F.lit(False).alias("whole")))
    return parts.groupBy("row").agg(F.max("units").alias("units"), F.max("runs").alias("runs"), F.max("whole").alias("whole"))


def repeated_units(docs: DataFrame, separator: str = LINE, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, unit, start, end`` of every unit of so many words that is not the earliest of its kind, short ones too."""
    places = _scanned(_numbered(docs), separator, min_words, None, GRAM)
    return _later(places, ["d1", "d2"], "units").select("doc_id", F.col("at").alias("unit"), "start", "end")


def remove_repeats(
    docs: DataFrame, separator: str = LINE, min_words: int = PASSAGE, window: int | None = PASSAGE, gram: int = GRAM
) -> DataFrame:
    """The documents with what stays of their texts, and ``removed`` behind their own columns: unit, start
    and end (in the original text) of everything that was removed, in order.

    ``min_words`` bounds the units that may go, ``window`` is the length of runs inside them (None: whole units only).
    """
    if window is not None and not 1 <= gram <= window <= min_words:
        raise ValueError("a gram fits into a window, and a window into the shortest unit that may go")
    numbered = _numbered(docs)
    met = attach_groups(numbered.select("rest", "text", "row"), _changes(numbered, separator, min_words, window, gram), ["row"])
    given = met.select("rest", "text", "units", "runs", "whole")
    out = given.mapInArrow(_remover(separator), T.StructType([*given.schema[:2], T.StructField("removed", _REMOVED)]))
    name = "removed"
    while name in docs.columns:
        name = "_" + name
    columns = [F.col("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns]
    return out.select(*columns, F.col("removed").alias(name))
