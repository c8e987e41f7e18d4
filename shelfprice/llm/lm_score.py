"""Log probability of texts by online logistic context mixing of bit predictors.

A text is a sequence of tokens (words, then one end), and a token is a sequence of bits: its way down the
Huffman tree of the most frequent training words. At every bit of it four predictors give a probability: one of
the tree node alone, and three of the node hashed with a context (the last of the most common words, the
previous word, the previous two words). Their stretched probabilities are combined by a weight set that is
gated by how often the contexts were seen and how deep the node lies, plus a correction that each document
learns as it is read; an adaptive map refines the result. Words beyond the
``LISTED`` most frequent share one leaf, which is mixed as all others are; behind it they are told apart by their counts, with one
added and one place for all unseen words, as in the base score.

Training is one pass over all training documents: each task learns online, predicting before it counts, and
its counts and weights are added to those of the other tasks. The counts of words cover all training
documents too. What is broadcast is bounded: the listed words, and per context a table whose slots follow the training
tokens, but at most ``1 << MOST_TABLE_BITS``. Words that are not listed meet their counts in a join instead, whose rows are rare words.

Defined results: a NULL text is empty and has its end alone; ids held out from training by the caller's rule
never count; without training documents every count is zero; rows that agree in id and text get equal scores;
an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfprice.plans.staging import stage

LISTED = 1 << 17
# Slots of a table of contexts follow the training tokens up to a bound; what a task holds and sends grows with them.
SLOTS_PER_TOKEN = 16
# Training tokens that a task learns from, at least.
TOKENS_PER_LEARNER = 1_000_000
MOST_TABLE_BITS = 20
LEAST_TABLE_BITS = 12
COMMON = 64
# The nodes that hold most tokens have slots of their own for the last common word.
DIRECT = 2048
# Tokens of a document that are scored before its correction is updated, and documents read side by side.
SEGMENT = 256
SIDE_BY_SIDE = 48
# Where nothing is learned, more documents share a pass, as every pass fetches much of the tables anew.
READ_SIDE_BY_SIDE = 96
# Documents that are sorted by length before they are learned from, bytes of text that are cut into words at once,
# and words that a task counts before it passes the counts on.
_TAKEN = 4 * SIDE_BY_SIDE
_TEXT = 8 << 20
_COUNTED = 3_000_000
_CLASSES = 16
# Slots that travel as one piece.
_PIECE = 1 << 12
# Sums that a piece has before these are added, far fewer than there are learners.
_SALTS = 8

_INPUTS = 5  # node, common word, previous word, previous two words, constant
_START = (0.4, 0.4, 0.2, 0.2, 0.0)
_START_PER_LEVEL = 0.2
_CONSTANT = 0.3
_PRIOR = 24.0
_GATES = 4 * 4 * 8
_STEPS = 33
_RATE, _OWN_RATE = 0.02, 1.0
_END = b""  # no word is empty
# A step of a way is its node with the depth, capped at 7, and the bit in the highest places.
_DEPTH, _BIT = 28, 31
_NODE = np.uint32((1 << _DEPTH) - 1)
# Counts whose logarithms are looked up, as most slots have such.
_LOGGED = 1 << 16


def tokens(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words (A-Z lowered, parted by ASCII white space) of all texts, one after the other, and how many each text has.

    Ends are left out.
    """
    # A slice is copied before it is cast, as pyarrow 23 lowers a cast slice wrongly.
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text, "")).cast(pa.large_string()))
    words, n = pc.list_flatten(parts), pc.list_value_length(parts).to_numpy().astype(np.int64)
    # White space at either end of a text leaves an empty part there.
    filled = pc.greater(pc.binary_length(words), 0)
    if not pc.all(filled).as_py():
        words = words.filter(filled)
        n = np.bincount(np.repeat(np.arange(len(n)), n)[filled.to_numpy(zero_copy_only=False)], minlength=len(n))
    return words.cast(pa.large_binary()), n


# --- the code of words ---------------------------------------------------------------------------


class Code:
    """Bits of the listed words: the way of every leaf from the root, whose nodes are numbered from the heaviest on."""

    def __init__(self, words: list[bytes], counts: list[int], other: int) -> None:
        """``words`` by falling count; ``other`` counts the tokens of all other words."""
        self.words = pa.array(words, pa.large_binary())
        self.unlisted = len(words)
        self.end = words.index(_END) if _END in words else self.unlisted
        weight = [*(max(1, c) for c in counts), max(1, other)]
        left, right, total = self._tree(weight)
        leaves, inner = len(weight), len(left)
        self.nodes = max(1, inner)
        parent = np.full(leaves + inner, -1, np.int64)
        turn = np.zeros(leaves + inner, np.uint32)
        depth = np.zeros(leaves + inner, np.int64)
        for k in range(inner - 1, -1, -1):
            for child, bit in ((left[k], 0), (right[k], 1)):
                parent[child], turn[child], depth[child] = leaves + k, bit, depth[leaves + k] + 1
        self.length = depth[:leaves]
        self.offset = np.cumsum(self.length) - self.length
        node = np.zeros(int(self.length.sum()), np.uint32)
        bit = np.zeros(len(node), np.uint32)
        # All leaves walk up at once.
        at, place = np.arange(leaves), self.offset + self.length - 1
        while len(open_ := np.flatnonzero(parent[at] >= 0)):
            at, place = at[open_], place[open_]
            node[place] = inner - 1 - (parent[at] - leaves)
            bit[place] = turn[at]
            at, place = parent[at], place - 1
        step = np.arange(len(node)) - np.repeat(self.offset, self.length)
        self.way = node | np.minimum(step >> 1, 7).astype(np.uint32) << np.uint32(_DEPTH) | bit << np.uint32(_BIT)
        weights = np.array(total, np.float64)
        ratio = weights[np.array(right, np.int64)] / weights[np.array(left, np.int64)] if inner else np.ones(1)
        self.stretched = np.log(ratio)[::-1].astype(np.float32)

    @property
    def node(self) -> np.ndarray:
        return (self.way & _NODE).astype(np.int64)

    @property
    def bit(self) -> np.ndarray:
        return (self.way >> np.uint32(_BIT)).astype(np.float32)

    @staticmethod
    def _tree(weight: list[int]) -> tuple[list[int], list[int], list[int]]:
        heap = [(w, i) for i, w in enumerate(weight)]
        heapq.heapify(heap)
        left, right, total = [], [], list(weight)
        while len(heap) > 1:
            (wa, a), (wb, b) = heapq.heappop(heap), heapq.heappop(heap)
            left.append(a)
            right.append(b)
            heapq.heappush(heap, (wa + wb, len(total)))
            total.append(wa + wb)
        return left, right, total


class Model:
    """Counts behind the hashed contexts, mixing weights and the adaptive map."""

    def __init__(self, code: Code, bits: int = LEAST_TABLE_BITS) -> None:
        self.code = code
        self.bits, self.direct = bits, min(DIRECT, code.nodes)
        self.first = (COMMON + 1) * self.direct
        size = self.first + 3 * (1 << bits)
        self.counts = np.zeros((size, 2), np.float32)  # of bits 0 and 1
        self.weights = np.repeat(np.array(_START, np.float32)[:, None], _GATES, axis=1)
        # A context that was seen more often starts with more weight.
        gate = np.arange(_GATES)
        self.weights[2] += _START_PER_LEVEL * (gate // 4 % 4)
        self.weights[3] += _START_PER_LEVEL * (gate % 4)
        self.power = np.full((_INPUTS, _GATES), 1e-2)
        self.seen, self.set = np.zeros(8 * _STEPS), np.zeros(8 * _STEPS)
        self.table: tuple[np.ndarray, np.ndarray] | None = None

    def freeze(self) -> Model:
        """Turn counts into stretched probabilities and how sure they are, for scoring."""
        n = self.counts + np.float32(0.4)
        np.log(n, out=n)
        self.table = (n[:, 1] - n[:, 0], _sureness(self.counts[:, 0] + self.counts[:, 1]))
        return self

    def read(self, documents: list[np.ndarray], learn: bool) -> np.ndarray:
        """log2 probability of each document's listed part, or 0 while learning; numbers of its tokens are given."""
        out = np.zeros(len(documents))
        order = np.argsort([len(d) for d in documents], kind="stable")
        together = SIDE_BY_SIDE if learn else READ_SIDE_BY_SIDE
        for at in range(0, len(documents), together):
            part = order[at : at + together]
            out[part] = self._side_by_side([documents[i] for i in part], learn)
        return out

    def pieces(self) -> Iterator[tuple[int, bytes]]:
        """What the model has learned, in pieces that can be added to those of another model."""
        flat = self.counts.reshape(-1)
        for i in range(0, len(flat), _PIECE):
            if (piece := flat[i : i + _PIECE]).any():
                yield i // _PIECE, piece.astype(np.float32).tobytes()
        n = max(1.0, float(self.seen.sum()))
        yield -1, np.concatenate(([n], n * self.weights.astype(np.float64).ravel(), self.seen, self.set)).tobytes()

    def load(self, pieces: dict[int, bytes]) -> Model:
        """Take over the sum of the pieces of many models; their weights are averaged by the bits they saw."""
        flat = self.counts.reshape(-1)
        for number, data in pieces.items():
            values = np.frombuffer(data, np.float64)
            if number >= 0:
                flat[number * _PIECE : number * _PIECE + len(values)] = values
            else:
                n, rest = values[0], values[1:]
                self.weights = (rest[: _INPUTS * _GATES] / n).reshape(_INPUTS, _GATES).astype(np.float32)
                self.seen, self.set = rest[_INPUTS * _GATES :].reshape(2, -1).copy()
        return self

    def _side_by_side(self, documents: list[np.ndarray], learn: bool) -> np.ndarray:
        code = self.code
        ids = np.concatenate(documents)
        lengths = np.array([len(d) for d in documents])
        begins = np.cumsum(lengths) - lengths
        place = np.arange(len(ids))
        own_begin = np.repeat(begins, lengths)
        before = np.concatenate(([0], ids[:-1]))
        nothing = code.unlisted + 1
        prev = np.where(place == own_begin, nothing, before)
        prev2 = np.where(place <= own_begin + 1, nothing, np.concatenate(([0, 0], ids[:-2]))[: len(ids)])
        last = np.maximum.accumulate(np.where(ids < COMMON, place, -1))
        last = np.concatenate(([-1], last[:-1]))
        common = np.where(last >= own_begin, ids[np.maximum(last, 0)], COMMON)
        word = (prev.astype(np.uint32) + 1) * np.uint32(0x9E3779B1)
        two = word ^ ((prev2.astype(np.uint32) + 7) * np.uint32(0x85EBCA6B))
        contexts = [common.astype(np.uint32), word, two]
        cost = np.zeros(len(documents))
        own = np.zeros((_INPUTS, len(documents)), np.float32)
        last_segment = (int(lengths.max()) - 1) // SEGMENT
        for segment in range(last_segment + 1):
            start = begins + segment * SEGMENT
            n = np.clip(begins + lengths - start, 0, SEGMENT)
            ends = np.cumsum(n)
            at = np.arange(ends[-1]) + np.repeat(start - (ends - n), n)
            leaf = ids[at]
            size = code.length[leaf]
            until = np.concatenate(([0], np.cumsum(size)))
            if not until[-1]:
                continue
            step = np.arange(until[-1])
            step += np.repeat(code.offset[leaf] - until[:-1], size)
            bits = np.diff(until[np.concatenate(([0], ends))])
            cost += self._bits(step, [c[at] for c in contexts], size, bits, own, segment > 0, segment < last_segment, learn)
        return cost

    def _refined(self, p: np.ndarray, cell: np.ndarray, bit: np.ndarray) -> np.ndarray:
        """log2 probability of the bits by an even mean of mixed and mapped probabilities.

        A map cell that has seen little stays near the mixed probability.
        """
        stay = _PRIOR / (_PRIOR + self.seen)
        refined = p * stay.astype(np.float32).take(cell)
        refined += (self.set / (_PRIOR + self.seen)).astype(np.float32).take(cell)
        refined += p
        refined *= 0.5
        np.clip(refined, 1e-6, 1 - 1e-6, out=refined)
        likely = np.abs(1 - bit - refined)
        return np.log2(likely, out=likely)

    def _slots(self, node: np.ndarray, contexts: list[np.ndarray], size: np.ndarray) -> np.ndarray:
        """Slots of every bit's node with the three contexts of its token, which has ``size`` bits."""
        common, word, two = contexts
        mixed = node * np.uint32(0xC2B2AE35)
        shift, table, direct = np.uint32(32 - self.bits), 1 << self.bits, np.uint32(self.direct)
        slots = _scratch("slots", (3, len(node)), np.int64)
        parts = (common * np.uint32(0x9E3779B1), 0x85EBCA6B), (word, 0x27D4EB2F), (two, 0x165667B1)
        for i, (context, factor) in enumerate(parts):
            hashed = np.repeat(context, size)
            hashed += mixed
            hashed *= np.uint32(factor)
            hashed >>= shift
            hashed += np.uint32(self.first + i * table)
            slots[i] = hashed if i else np.where(node < direct, np.repeat(common * direct, size) + node, hashed)
        return slots

    def _seen_by(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the contexts say in the stretched domain, and how sure the last two are."""
        if self.table is not None:
            return _scratch.take("stretched", self.table[0], slots), _scratch.take("sure", self.table[1], slots[1:])
        # Both counts of a slot are fetched as one number.
        both = _scratch.take("both", self.counts.view(np.float64).reshape(-1), slots).view(np.float32)
        logs = _logs(both)
        return logs[:, 1::2] - logs[:, ::2], _sureness(both[1:, ::2] + both[1:, 1::2])

    def _bits(
        self, step: np.ndarray, contexts: list[np.ndarray], size: np.ndarray, bits: np.ndarray, own: np.ndarray, corrected: bool, onward: bool, learn: bool
    ) -> np.ndarray:
        """log2 probability of the bits of one segment of each document (0 while learning, where nobody asks for it).

        They lie in the order of the documents: ``size`` says how many belong to each token, ``bits`` how many to each
        document. ``own`` is all zero unless ``corrected``, and not asked for again unless ``onward``.
        """
        way = _scratch.take("way", self.code.way, step)
        node, bit = way & _NODE, (way >> np.uint32(_BIT)).astype(np.float32)
        depth = (way >> np.uint32(_DEPTH)) & np.uint32(7)
        slots = self._slots(node, contexts, size)
        stretched, sure = self._seen_by(slots)
        inputs = [_scratch.take("node", self.code.stretched, node), *stretched]
        gate = (depth << np.uint32(4)).astype(np.int64)
        gate += sure[0] * np.int8(4) + sure[1]
        s = _scratch.take("s", self.weights[_INPUTS - 1], gate)
        if corrected:
            s += np.repeat(own[_INPUTS - 1], bits)
        s *= np.float32(_CONSTANT)
        for i, x in enumerate(inputs):
            w = _scratch.take("w", self.weights[i], gate)
            if corrected:
                w += np.repeat(own[i], bits)
            w *= x
            s += w
        np.clip(s, -12, 12, out=s)
        p = np.exp(-s)
        p += 1
        np.reciprocal(p, out=p)
        s += 12
        s *= (_STEPS - 1) / 24
        cell = np.rint(s, out=s).astype(np.int64)
        cell += depth * np.uint32(_STEPS)
        some = bits > 0
        begins = (np.cumsum(bits) - bits)[some]
        cost = np.zeros(len(bits))
        if not learn:
            cost[some] = np.add.reduceat(self._refined(p, cell, bit), begins, dtype=np.float64)

        if not (learn or onward):
            return cost
        error = bit - p
        gradients = [error * x for x in inputs]
        gradients.append(error * np.float32(_CONSTANT))
        for i, g in enumerate(gradients if onward else ()):
            own[i, some] += (_OWN_RATE * np.add.reduceat(g, begins) / (bits[some] + 2000)).astype(np.float32)
        if learn:
            seen = np.bincount(gate, minlength=_GATES)
            for i, g in enumerate(gradients):
                gradient = np.bincount(gate, weights=g, minlength=_GATES) / np.sqrt(seen + 1)
                self.power[i] += gradient**2
                self.weights[i] += (_RATE * gradient / np.sqrt(self.power[i])).astype(np.float32)
            one = (way >> np.uint32(_BIT)).astype(np.int64)
            hits = np.bincount(2 * cell + one, minlength=16 * _STEPS).reshape(-1, 2)
            self.seen += hits.sum(axis=1)
            self.set += hits[:, 1]
            slots <<= 1
            slots += one
            np.add.at(self.counts.reshape(-1), slots.reshape(-1), np.float32(1))
        return cost


class _Scratch:
    """Memory that the vectors of one segment leave to those of the next, as fresh memory is not in the cache.

    Every process has its own.
    """

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}
        self.logs = np.log(np.arange(_LOGGED, dtype=np.float32) + np.float32(0.4))

    def __reduce__(self) -> tuple:
        return _Scratch, ()

    def __call__(self, name: str, shape: tuple[int, ...], kind: type) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.held or len(self.held[name]) < size:
            self.held[name] = np.empty(size, kind)
        return self.held[name][:size].reshape(shape)

    def take(self, name: str, values: np.ndarray, index: np.ndarray) -> np.ndarray:
        """``values`` at places that all exist."""
        return values.take(index, out=self(name, index.shape, values.dtype), mode="clip")


_scratch = _Scratch()


def _logs(counts: np.ndarray) -> np.ndarray:
    index = _scratch("index", counts.shape, np.int64)
    index[:] = counts
    logs = _scratch.take("logs", _scratch.logs, index)
    if counts.max(initial=0) >= _LOGGED:
        large = counts >= _LOGGED
        logs[large] = np.log(counts[large] + np.float32(0.4))
    return logs


def _sureness(n: np.ndarray) -> np.ndarray:
    return (n > 0).view(np.int8) + (n > 3).view(np.int8) + (n > 30).view(np.int8)


# --- jobs ----------------------------------------------------------------------------------------


def _rebuilt(kind: type, state: dict) -> object:
    made = kind.__new__(kind)
    made.__dict__.update(state)
    return made


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut behind a multiple of ``_TAKEN`` documents, as soon as these have ``_TEXT`` bytes."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
        first = 0
        for at in range(_TAKEN, batch.num_rows + _TAKEN, _TAKEN):
            if at >= batch.num_rows or size[first:at].sum() >= _TEXT:
                yield batch.slice(first, at - first)
                first = at


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(ends: int, taken: list[pa.Array]) -> pa.RecordBatch:
        counts = pc.value_counts(pa.chunked_array(taken, pa.large_binary()))
        words = pa.concat_arrays([counts.field("values"), pa.array([_END], pa.large_binary())])
        n = pa.concat_arrays([counts.field("counts"), pa.array([ends], pa.int64())])
        return pa.RecordBatch.from_arrays([words.cast(pa.binary()), n], ["word", "n"])

    ends, taken = 0, []
    for part in _parts(batches):
        words, n = tokens(part.column("text"))
        ends += len(n)
        taken.append(words)
        if sum(map(len, taken)) > _COUNTED:
            yield out(ends, taken)
            ends, taken = 0, []
    if ends:
        yield out(ends, taken)


def _numbers(code: Code, words: pa.Array, n: np.ndarray) -> np.ndarray:
    """Numbers of all tokens: the words of each text and its end."""
    ids = np.full(len(words) + len(n), code.end, np.int64)
    is_word = np.ones(len(ids), bool)
    is_word[np.cumsum(n + 1) - 1] = False
    ids[is_word] = pc.fill_null(pc.index_in(words, value_set=code.words), code.unlisted).to_numpy()
    return ids


def _learner(code: object, bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(_rebuilt(Code, code.value), bits)
        for part in _parts(batches):
            words, n = tokens(part.column("text"))
            documents = np.split(_numbers(model.code, words, n), np.cumsum(n + 1)[:-1])
            for at in range(0, len(documents), _TAKEN):
                model.read(documents[at : at + _TAKEN], learn=True)
        number, data = zip(*model.pieces(), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.array(data, pa.binary())], ["piece", "data"])

    return run


def _values(number: int, data: bytes, counts: type) -> np.ndarray:
    return np.frombuffer(data, counts if number >= 0 else np.float64)


def _add_pieces(counts: type) -> Callable:
    """Sums of pieces; ``counts`` is the type in which the numbers of slots arrive, and they leave as doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, data in zip(batch.column("piece").to_pylist(), batch.column("data").to_pylist(), strict=True):
                values = _values(number, data, counts)
                sums[number] = sums[number] + values if number in sums else values.astype(np.float64)
        for number, values in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([values.tobytes()], pa.binary())], ["piece", "data"])

    return run


_TAIL = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))


def _tails(code: Code, words: pa.Array, n: np.ndarray, ids: np.ndarray) -> pa.Array:
    """Words that are not listed with their counts, per document; an entry without a word tells how often it occurs."""
    of = np.repeat(np.arange(len(n)), n + 1)
    rare = np.flatnonzero(ids == code.unlisted)
    # Before a word lie the ends of the documents before; all ends are the one behind the words.
    is_end = rare == np.cumsum(n + 1)[of[rare]] - 1
    found = pa.concat_arrays([words, pa.array([_END], words.type)]).take(np.where(is_end, len(words), rare - of[rare])).dictionary_encode()
    pair, times = np.unique(of[rare] * len(ids) + found.indices.to_numpy(), return_counts=True)
    entries = np.bincount(pair // len(ids), minlength=len(n))
    until = np.cumsum(entries + (entries > 0))
    is_word = np.ones(until[-1], bool)
    is_word[until[entries > 0] - 1] = False
    at, count = np.zeros(len(is_word), np.int64), np.ones(len(is_word), np.int64)
    at[is_word], count[is_word] = pair % len(ids), times
    word = found.dictionary.take(pa.array(at, mask=~is_word)).cast(pa.binary())
    offsets = pa.array(np.concatenate(([0], until)), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([word, pa.array(count)], fields=list(_TAIL.value_type)))


def _reader(code: object, model: object, base: object) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _rebuilt(Model, {**model.value, "code": _rebuilt(Code, code.value)})
        logs = np.append(base.value, 0.0)
        for part in _parts(batches):
            words, n = tokens(part.column("text"))
            ids = _numbers(reader.code, words, n)
            begins = np.cumsum(n + 1) - (n + 1)
            score = reader.read(np.split(ids, begins[1:]), learn=False) * np.log10(2)
            listed = np.add.reduceat((ids < reader.code.unlisted).astype(np.int64), begins)
            columns = [part.column("doc_id"), part.column("text_hash"), part.column("n_bytes"), pa.array(n + 1), pa.array(listed)]
            columns += [pa.array(np.add.reduceat(logs.take(ids), begins)), pa.array(score), _tails(reader.code, words, n, ids)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_bytes", "n_tokens", "n_listed", "base", "score", "tail"])

    return run


def _least_count(words: DataFrame) -> int:
    """Count from which on words are listed: the smallest that no more than ``LISTED`` words have.

    Words are counted by classes of their counts, a few hundred at most, as sorting them would send the most
    frequent words of every task to the driver. Counts below ``_CLASSES`` are classes of their own.
    """
    c = F.col("c")
    steps = F.floor(F.log2(c / _CLASSES) * _CLASSES)
    least = F.when(c < _CLASSES, c).otherwise(F.ceil(_CLASSES * F.pow(F.lit(2.0), steps / _CLASSES)))
    classes = words.groupBy(least.cast("long").alias("least")).agg(F.count(F.lit(1)).alias("n")).collect()
    taken, least_count = 0, 1 << 62
    for least, n in sorted(classes, reverse=True):
        taken += n
        if taken > LISTED:
            break
        least_count = least
    return least_count


def lm_scores(docs: DataFrame, training: Column) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` of every document; the
    documents that fulfil ``training`` are learned from. The score is a log10 probability; bits per byte count
    the end of a text as one byte."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    context = docs.sparkSession.sparkContext
    texts = docs.where(training).select("text")
    words = texts.mapInArrow(_count_words, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("c"))
    words = stage(words, "lm_words")
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = sorted(((r.c, bytes(r.word)) for r in words.where(F.col("c") >= _least_count(words)).collect()), reverse=True)
    counts = np.array([c for c, _ in top], np.int64)
    other = total - int(counts.sum())
    listed = Code([w for _, w in top], counts.tolist(), other)
    del top
    code = context.broadcast(listed.__dict__)

    bits = min(MOST_TABLE_BITS, max(LEAST_TABLE_BITS, int(SLOTS_PER_TOKEN * total).bit_length()))
    # A learner sends all it has learned, so it should have read something.
    learners = texts.coalesce(max(1, int(total) // TOKENS_PER_LEARNER))
    learned = learners.mapInArrow(_learner(code, bits), "piece int, data binary")
    # Sums in two steps, so that no task adds up the pieces of all others.
    salted = learned.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(_SALTS)))
    halfway = salted.repartition("piece", "salt").select("piece", "data").mapInArrow(_add_pieces(np.float32), "piece int, data binary")
    added = stage(halfway.repartition("piece").mapInArrow(_add_pieces(np.float64), "piece int, data binary"), "lm_pieces")
    mixer = Model(listed, bits).load({r.piece: bytes(r.data) for r in added.collect()}).freeze()
    state = {k: v for k, v in mixer.__dict__.items() if k not in ("code", "counts")}
    base = context.broadcast(np.log10((counts + 1) / (total + distinct + 1)))

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, text_hash bigint, n_bytes bigint, n_tokens bigint, n_listed bigint, base double, score double, "
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    read = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), n_bytes, "text").mapInArrow(
        _reader(code, context.broadcast(state), base), schema + "tail array<struct<word:binary,n:bigint>>"
    )
    read = stage(read, "lm_documents")
    rare = read.select("doc_id", "text_hash", F.explode("tail").alias("t")).select("doc_id", "text_hash", "t.*")
    met = rare.join(words, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    is_word = F.col("word").isNotNull()
    beyond = max(1, total - int(counts.sum()) + distinct - len(counts) + 1)
    in_all, in_rest = F.log10((F.col("c") + 1) / (total + distinct + 1)), F.log10((F.col("c") + 1) / beyond)
    sums = met.groupBy(F.col("doc_id").alias("of"), F.col("text_hash").alias("hash")).agg(
        F.count_if(~is_word).alias("rows"),
        F.sum(F.when(is_word, F.col("n") * in_all)).alias("tail_base"),
        F.sum(F.when(is_word, F.col("n") * in_rest)).alias("tail_score"),
        F.sum(F.when(is_word & (F.col("c") > 0), F.col("n")).otherwise(0)).alias("tail_known"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("hash"))
    joined = read.drop("tail").join(sums, same, "left")
    tail = lambda c: F.coalesce(F.col(c) / F.col("rows"), F.lit(0.0))
    return joined.select(
        "doc_id",
        "n_tokens",
        (F.col("n_listed") + tail("tail_known").cast("long")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + tail("tail_base")).alias("base_score"),
        (F.col("score") + tail("tail_score")).alias("score"),
        ((F.col("score") + tail("tail_score")) * -math.log2(10) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
