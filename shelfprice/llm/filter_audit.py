"""What each filter of a chain removes, for every order of the filters, by a Gray-code walk over their subsets.

A document fails some of the filters, which makes a mask; per part of the corpus (its source) there are at most
``2 ** k`` masks, so one aggregation with map-side combine leaves a table of mask cells: documents,
documents of good quality, toxic documents. All orders follow from these cells:

- the walk visits all subsets of the filters, from one to the next by toggling a single filter. Every
  cell keeps a counter of its active failures; a cell whose counter comes from or goes to zero leaves or joins
  the running survivors, which are stored for each of the ``2 ** k`` states;
- a step of an order is a pair of states, and what it removes is their difference. So no order
  looks at a document again.

The walk runs in tasks, over one row of cells per part, however many parts there are.

Filters of the registered query (words are runs of other than space, tab, line feed, vertical tab, form feed and carriage
return): A fewer than 200 words; B under half of the words distinct; C over 2 % of the code points in A-Z;
D any of ``[#$%&*|]``; E the same text as a document with a smaller id anywhere in the table. E compares
SHA-256 digests, whose minima are combined on the map side and come back to the rows by broadcast if measured small, else by a
shuffle that spreads hot texts.

Defined results: a NULL text is empty (it fails A only, and E if there is an earlier empty text); rows with one id
and one text do not fail E through each other; a NULL id is neither smaller nor larger than any other and has no
labels; a NULL source counts as the empty string; of several label rows of an id any 1 counts; a
document without labels is neither good nor toxic; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfprice.llm.text import words
from shelfprice.plans.joins import attach_groups
from shelfprice.plans.staging import stage

MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 2
SYMBOLS = "[#$%&*|]"
FILTERS = "ABCDE"

# Per cell, and per state of the walk.
MEASURES = ("n", "good", "toxic")


def gray_walk(cells: np.ndarray, filters: int) -> np.ndarray:
    """Survivors of every subset of the filters: ``[state, measure]`` from ``[mask, measure]``."""
    masks = np.arange(1 << filters)
    failures = np.zeros(1 << filters, np.int64)
    running = cells.sum(axis=0)
    stored = np.zeros_like(cells)
    stored[0] = running
    state = 0
    for step in range(1, 1 << filters):
        # The bit that changes between two Gray codes is the lowest one of the step's number.
        toggled = step & -step
        state ^= toggled
        hit = (masks & toggled) != 0
        if state & toggled:
            running = running - cells[hit & (failures == 0)].sum(axis=0)
            failures[hit] += 1
        else:
            failures[hit] -= 1
            running = running + cells[hit & (failures == 0)].sum(axis=0)
        stored[state] = running
    return stored


def _steps(names: str) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all steps of all orders: the order, the number of the step, its filter, the states before and after."""
    rows = []
    for order in permutations(range(len(names))):
        state = 0
        for number, filter_ in enumerate(order):
            rows.append(("".join(names[i] for i in order), number + 1, filter_, state, state | 1 << filter_))
            state |= 1 << filter_
    orders, *numbers = zip(*rows, strict=True)
    return list(orders), *(np.array(x, np.int64) for x in numbers)


def _walker(names: str) -> Callable:
    orders, number, of, before, after = _steps(names)
    k, everything = len(names), (1 << len(names)) - 1
    single = 1 << np.arange(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in zip(batch.column("part"), batch.column("cells"), strict=True):
                cells = np.zeros((1 << k, len(MEASURES)), np.int64)
                for cell in found.as_py():
                    cells[cell["mask"]] = [cell[m] for m in MEASURES]
                stored = gray_walk(cells, k)
                kept, gone = stored[after], stored[before] - stored[after]
                fails = (stored[0] - stored[single])[of, 0]
                unique = (stored[everything ^ single] - stored[everything])[of, 0]
                shapley = np.bincount(of, gone[:, 0], k).astype(np.int64)[of]
                columns = [kept[:, 0], gone[:, 0], fails - gone[:, 0], unique, gone[:, 1], gone[:, 2], shapley]
                arrays = [pa.array([part.as_py()] * len(orders), pa.string()), pa.array(orders, pa.string()), pa.array(number, pa.int32())]
                yield pa.RecordBatch.from_arrays([*arrays, *map(pa.array, columns)], names=RESULT.names)

    return run


_COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
RESULT = T.StructType(
    [
        T.StructField("part", T.StringType()),
        T.StructField("filter_order", T.StringType()),
        T.StructField("step", T.IntegerType()),
        *[T.StructField(name, T.LongType()) for name in _COUNTS],
    ]
)


def audit(rows: DataFrame, failures: dict[str, Column], part: Column, good: Column, toxic: Column) -> DataFrame:
    """One row per part, order of the filters and step, as ``RESULT`` has them.

    ``failures`` maps a letter to the condition under which a row fails that filter; NULL is no failure. The
    result has ``k! * k`` rows a part, so ``k`` should stay small.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    names = "".join(failures)
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    mask = reduce(lambda a, b: a + b, [flag(c) * (1 << i) for i, c in enumerate(failures.values())])
    marked = rows.select(
        F.coalesce(part, F.lit("")).alias("part"), mask.alias("mask"), flag(good).alias("good"), flag(toxic).alias("toxic")
    )
    counts = [F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")]
    cells = marked.groupBy("part", "mask").agg(*counts)
    # At most 2 ** k cells a part.
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("cells"))
    return parts.mapInArrow(_walker(names), RESULT)


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions A to D of one text."""
    text = F.coalesce(text, F.lit(""))
    found = words(text)
    n = F.size(found)
    return {
        "A": n < MIN_WORDS,
        "B": F.size(F.array_distinct(found)) * 100 < n * MIN_DISTINCT_PERCENT,
        "C": F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * MAX_CAPITALS_PERCENT,
        "D": text.rlike(SYMBOLS),
    }


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``good`` and ``toxic`` of their ``doc_id``, NULL where there is no label."""
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
    marks = known.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    return attach_groups(rows, marks, ["doc_id"])


def with_earlier(rows: DataFrame) -> DataFrame:
    """``rows`` (``doc_id, digest`` and more) with ``first``, the smallest id of a text that several ids have."""
    ids = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    return attach_groups(rows, ids.where("first < last").drop("last"), ["digest"])


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the filters A to E over ``docs`` (``doc_id, text, source``), by source."""
    text = F.coalesce(F.col("text"), F.lit(""))
    flags = [c.alias(f"fails_{name}") for name, c in text_failures(text).items()]
    # Texts are read once; from here on a row is a few flags and a digest.
    measured = stage(docs.select("doc_id", F.col("source").alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), *flags), "audit")
    rows = with_labels(with_earlier(measured), labels)
    failures = {name: F.col(f"fails_{name}") for name in FILTERS[:-1]}
    failures["E"] = F.col("doc_id") > F.col("first")
    return audit(rows, failures, F.col("part"), F.col("good"), F.col("toxic"))
