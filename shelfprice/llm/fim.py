"""Fill-in-the-middle: a text is cut at two line starts and its parts change places behind sentinels.

A document's cuts, its form and whether it is transformed at all follow from a SHA-256 of a seed and its id,
so that a retried task draws the same. In a byte array that holds the text, the sentinels are inserted at the
start, at the first cut and at the second cut; then the parts change places by one rotation, made of
three reversals in place:

- ``psm``: prefix, suffix, middle, by rotating what lies behind the prefix;
- ``spm``: suffix, prefix, middle, by rotating everything.

``restore`` needs the output and its form only: it finds the sentinels, rotates back and takes them out. A text
that holds a sentinel itself stays plain, so what is found is what was inserted (no sentinel overlaps another).

All rows are worked on by themselves: no shuffle, and at most a few copies of one text and ``OUT_BYTES`` of
output in memory beside the batch that Spark hands over.

Defined results: a NULL text counts as empty, an empty text is plain; a NULL id draws as the empty id, and rows
with one id draw alike; bytes that are no UTF-8 pass as they are; an empty table gives an empty result. The
columns of the input but its text come first; an output column whose name is taken gets underscores before it.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED = 7
RATE_PERCENT = 100
SPM_PERCENT = 50
# A batch of output is handed on when it holds this much text.
OUT_BYTES = 8 * 1024 * 1024
_FOLLOWING = bytes(range(0x80, 0xC0))


def rotate(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """``start:middle`` and ``middle:end`` change places: each is reversed, then both together."""
    for a, b in ((start, middle), (middle, end), (start, end)):
        buffer[a:b] = buffer[a:b][::-1]


def line_ends(text: bytes) -> list[int]:
    """Where the lines end, each with its line feed; the last one may have none."""
    ends, at = [], text.find(b"\n")
    while at >= 0:
        ends.append(at + 1)
        at = text.find(b"\n", at + 1)
    if text and not text.endswith(b"\n"):
        ends.append(len(text))
    return ends


def draws(doc_id: str, seed: int) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    return h1, h2, h3, h4


def transform(text: bytes, doc_id: str, seed: int, rate: int, spm: int) -> tuple[bytes, str, int, int, int]:
    """Output, form, number of lines, and where the prefix and the middle end."""
    ends = line_ends(text)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate:
        return text, PLAIN, len(ends), 0, 0
    low, high = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    cut1, cut2 = (0, *ends)[low], (0, *ends)[high]
    buffer = bytearray(text)
    buffer[cut2:cut2] = SUFFIX
    buffer[cut1:cut1] = MIDDLE
    buffer[0:0] = PREFIX
    at_middle = len(PREFIX) + cut1
    at_suffix = at_middle + len(MIDDLE) + cut2 - cut1
    form = SPM if h4 % 100 < spm else PSM
    rotate(buffer, at_middle if form == PSM else 0, at_suffix, len(buffer))
    return bytes(buffer), form, len(ends), cut1, cut2


def restore_text(output: bytes, form: str) -> bytes:
    """The text again, from the output and its form alone."""
    if form == PLAIN:
        return output
    buffer = bytearray(output)
    start = buffer.index(SUFFIX)
    behind = buffer.index(MIDDLE if form == PSM else PREFIX)
    rotate(buffer, start, behind, len(buffer))
    # Prefix, middle and suffix are in order; the last sentinel goes first, so that places before it hold.
    cut1 = buffer.index(MIDDLE)
    cut2 = len(buffer) - (behind - start)
    del buffer[cut2 : cut2 + len(SUFFIX)]
    del buffer[cut1 : cut1 + len(MIDDLE)]
    del buffer[: len(PREFIX)]
    return bytes(buffer)


def _chars(text: bytes) -> int:
    return len(text.translate(None, _FOLLOWING))


def _in_parts(rows: Iterator[tuple[int, tuple]], batch: pa.RecordBatch, schema: pa.Schema, text_at: int) -> Iterator[pa.RecordBatch]:
    """Batches of the input's ``rest`` and the computed columns, cut by the bytes of the computed text."""

    def packed(numbers: list[int], values: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*values), list(schema)[1:], strict=True)]
        rest = batch.column("rest").take(pa.array(numbers, pa.int32()))
        return pa.RecordBatch.from_arrays([rest, *columns], names=schema.names)

    numbers, values, size = [], [], 0
    for number, value in rows:
        numbers.append(number)
        values.append(value)
        size += len(value[text_at] or b"")
        if size >= OUT_BYTES:
            yield packed(numbers, values)
            numbers, values, size = [], [], 0
    if numbers:
        yield packed(numbers, values)


def _transformer(seed: int, rate: int, spm: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = [pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            fields = [("rest", batch.column("rest").type), *zip(("output", "form", "n", "prefix_chars", "middle_chars"), kinds, strict=True)]

            def rows(batch: pa.RecordBatch = batch) -> Iterator[tuple[int, tuple]]:
                for number, (doc_id, text) in enumerate(zip(batch.column("id"), batch.column("text"), strict=True)):
                    text = text.as_py()
                    output, form, n, cut1, cut2 = transform(text, doc_id.as_py(), seed, rate, spm)
                    sizes = (None, None) if form == PLAIN else (_chars(text[:cut1]), _chars(text[cut1:cut2]))
                    yield number, (output, form, n, *sizes)

            yield from _in_parts(rows(), batch, pa.schema(fields), 0)

    return run


def _restorer() -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:

            def rows(batch: pa.RecordBatch = batch) -> Iterator[tuple[int, tuple]]:
                for number, (output, form) in enumerate(zip(batch.column("output"), batch.column("form"), strict=True)):
                    yield number, (restore_text(output.as_py(), form.as_py()) if output.is_valid else None,)

            yield from _in_parts(rows(), batch, pa.schema([("rest", batch.column("rest").type), ("restored", pa.binary())]), 0)

    return run


def _free(name: str, taken: list[str]) -> str:
    while name in taken:
        name = "_" + name
    return name


def _unpacked(df: DataFrame, columns: list[str], **more: Column) -> DataFrame:
    own = [F.col(f"rest.`{c}`").alias(c) for c in columns]
    return df.select(*own, *[value.alias(_free(name, columns)) for name, value in more.items()])


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE_PERCENT, spm: int = SPM_PERCENT) -> DataFrame:
    """``docs`` with ``output``, ``form``, ``n`` (lines), ``prefix_chars`` and ``middle_chars`` (NULL if plain).

    ``rate`` percent of the documents are transformed, ``spm`` percent of these with the suffix first.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    packed = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns if c != "text"]).alias("rest"),
        F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("id"),
        F.coalesce(docs["text"], F.lit("")).cast("binary").alias("text"),
    )
    # The text itself is not carried: plain or not, the output gives it back.
    kept = [c for c in docs.columns if c != "text"]
    added = T.StructType.fromDDL("output binary, form string, n bigint, prefix_chars bigint, middle_chars bigint")
    out = packed.mapInArrow(_transformer(seed, rate, spm), T.StructType([packed.schema["rest"], *added]))
    return _unpacked(out, kept, output=F.col("output").cast("string"), **{c: F.col(c) for c in ("form", "n", "prefix_chars", "middle_chars")})


def restore(transformed: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """``transformed`` with ``restored``, the exact text rebuilt from the columns ``output`` and ``form``."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    packed = transformed.select(
        F.struct(*[transformed[f"`{c}`"] for c in transformed.columns]).alias("rest"),
        transformed[f"`{output}`"].cast("binary").alias("output"),
        transformed[f"`{form}`"].alias("form"),
    )
    out = packed.mapInArrow(_restorer(), T.StructType([packed.schema["rest"], T.StructField("restored", T.BinaryType())]))
    return _unpacked(out, transformed.columns, restored=F.col("restored").cast("string"))
