"""Toxicity by a bidirectional gated recurrent network over characters and words, in numpy.

A word is read twice: as a hashed word embedding, and letter by letter (UTF-8 bytes) by a small
bidirectional GRU. A window of ``WINDOW`` such words is read by a second bidirectional GRU; attention
pooling weighs its states, and a logistic unit gives the window's toxicity. Windows overlap by half and
cover the whole text; a document scores as its most toxic window, brought to a probability by a logistic
fit on documents that were kept from the training of the network.

Training: labels belong to documents, not to windows, so each round trains on the window that stands for
its document at that time (multiple-instance learning): the most toxic one of a toxic document, and the
most toxic ones of a clean document. In the first round the window with the word that is most typical of
toxic documents stands in. At most ``SAMPLE_PER_CLASS`` labelled documents per class of at most
``SAMPLE_BYTES`` bytes are used, chosen by a hash; scoring covers all documents and whole texts. Only the
text is an input of the score.

Defined results: NULL, empty and blank texts are one window without words and get that window's score;
labels of a document that contradict each other count as toxic; rows repeat as they are; without labels of
both classes every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 32
STRIDE = WINDOW // 2
SAMPLE_PER_CLASS = 1500
SAMPLE_BYTES = 100_000
TOXIC_SHARE = 0.2
ROUNDS = 7
STEPS = 40
BATCH = 64
RATE = 0.006

_BUCKETS = 1 << 13
_WORD_DIM = 8
_CHAR_DIM = 8
_CHAR_HIDDEN = 8
_HIDDEN = 12
_ATTENTION = 8
# Sign characters around a word that are no part of it.
_AROUND = b"\"'()[]{}<>.,;:!?*#$%&|=+~^_/-\\`"
# Windows that are read at once, and words whose letters are.
_WINDOWS_AT_ONCE = 2048
_WORDS_AT_ONCE = 4096
# Words whose inputs a task remembers before it starts anew.
_REMEMBERED = 600_000

Weights = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def initial_weights(seed: int = 7) -> Weights:
    draw = np.random.default_rng(seed)

    def normal(*shape: int) -> np.ndarray:
        return (draw.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    w = {"word": 0.1 * draw.standard_normal((_BUCKETS, _WORD_DIM)).astype(np.float32)}
    w["char"] = 0.3 * draw.standard_normal((257, _CHAR_DIM)).astype(np.float32)
    inputs = _WORD_DIM + 2 * _CHAR_HIDDEN
    for side in "fb":
        w[f"cW{side}"], w[f"cb{side}"] = normal(_CHAR_DIM, 3 * _CHAR_HIDDEN), np.zeros(3 * _CHAR_HIDDEN, np.float32)
        w[f"cU{side}"] = normal(_CHAR_HIDDEN, 3 * _CHAR_HIDDEN)
        w[f"W{side}"], w[f"b{side}"] = normal(inputs, 3 * _HIDDEN), np.zeros(3 * _HIDDEN, np.float32)
        w[f"U{side}"] = normal(_HIDDEN, 3 * _HIDDEN)
    w["A"], w["a"] = normal(2 * _HIDDEN, _ATTENTION), normal(_ATTENTION, 1)[:, 0]
    w["o"], w["ob"] = normal(2 * _HIDDEN, 1)[:, 0], np.zeros(1, np.float32)
    return w


# --- layers --------------------------------------------------------------------------------------


def gru(inputs: np.ndarray, u: np.ndarray, mask: np.ndarray | None) -> tuple[np.ndarray, list]:
    """States (T, B, H) from projected inputs (T, B, 3H); where ``mask`` (T, B) is 0 the state is kept."""
    steps, batch, width = inputs.shape
    size = width // 3
    h = np.zeros((batch, size), np.float32)
    states, memory = np.empty((steps, batch, size), np.float32), []
    for t in range(steps):
        a = h @ u
        gates = _sigmoid(inputs[t, :, : 2 * size] + a[:, : 2 * size])
        z, r = gates[:, :size], gates[:, size:]
        n = np.tanh(inputs[t, :, 2 * size :] + r * a[:, 2 * size :])
        new = n + z * (h - n)
        if mask is not None:
            new = np.where(mask[t][:, None], new, h)
        memory.append((h, a[:, 2 * size :], z, r, n))
        states[t] = h = new
    return states, memory


def gru_back(grad: np.ndarray, u: np.ndarray, memory: list, mask: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the projected inputs and of ``u`` from those of the states."""
    steps, batch, size = grad.shape
    d_inputs, d_u = np.empty((steps, batch, 3 * size), np.float32), np.zeros_like(u)
    carry = np.zeros((batch, size), np.float32)
    for t in range(steps - 1, -1, -1):
        h, an, z, r, n = memory[t]
        d = grad[t] + carry
        kept = 0
        if mask is not None:
            m = mask[t][:, None]
            kept, d = np.where(m, 0, d), np.where(m, d, 0)
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (h - n) * z * (1 - z)
        dr = dn * an * r * (1 - r)
        d_inputs[t] = np.concatenate((dz, dr, dn), axis=1)
        da = np.concatenate((dz, dr, dn * r), axis=1)
        d_u += h.T @ da
        carry = d * z + da @ u.T + kept
    return d_inputs, d_u


def _letters(vocabulary: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte codes (T, V) and mask of words; code 256 fills up."""
    longest = max(map(len, vocabulary), default=0) or 1
    codes = np.full((len(vocabulary), longest), 256, np.int64)
    for i, word in enumerate(vocabulary):
        codes[i, : len(word)] = np.frombuffer(word, np.uint8)
    return codes.T, codes.T < 256


def _bucket(word: bytes) -> int:
    return zlib.crc32(word) % (_BUCKETS - 1) + 1


def _word_inputs(w: Weights, vocabulary: list[bytes]) -> tuple[np.ndarray, tuple]:
    """Inputs (V, D) of distinct words, and what their gradient needs."""
    codes, mask = _letters(vocabulary)
    letters = w["char"][codes]
    forward, mf = gru(letters @ w["cWf"] + w["cbf"], w["cUf"], mask)
    backward, mb = gru((letters @ w["cWb"] + w["cbb"])[::-1], w["cUb"], mask[::-1])
    buckets = np.array([_bucket(x) if x else 0 for x in vocabulary])
    inputs = np.concatenate((w["word"][buckets], forward[-1], backward[-1]), axis=1)
    inputs[buckets == 0] = 0  # the place filler and words without letters
    return inputs, (codes, mask, letters, mf, mb, buckets)


def _pool(w: Weights, states: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Attention pooling over (T, B, 2H): pooled states, weights and what they came from."""
    seen = np.tanh(states @ w["A"])
    score = np.where(real, seen @ w["a"], -1e9)
    score = np.exp(score - score.max(axis=0))
    weight = score / score.sum(axis=0)
    return (states * weight[:, :, None]).sum(axis=0), weight, seen


def _step(w: Weights, words: list[list[bytes]], target: np.ndarray) -> tuple[float, Weights]:
    """Loss and gradients of one batch of windows."""
    vocabulary = sorted({x for window in words for x in window} | {b""})
    number = {x: i for i, x in enumerate(vocabulary)}
    ids = np.full((WINDOW, len(words)), number[b""])
    for b, window in enumerate(words):
        ids[: len(window), b] = [number[x] for x in window]
    real = np.arange(WINDOW)[:, None] < np.maximum(1, [len(x) for x in words])
    inputs, (codes, mask, letters, mf, mb, buckets) = _word_inputs(w, vocabulary)
    x = inputs[ids]
    forward, wf = gru(x @ w["Wf"] + w["bf"], w["Uf"], None)
    backward, wb = gru((x @ w["Wb"] + w["bb"])[::-1], w["Ub"], None)
    states = np.concatenate((forward, backward[::-1]), axis=2)
    pooled, weight, seen = _pool(w, states, real)
    p = _sigmoid(pooled @ w["o"] + w["ob"][0])
    loss = -np.mean(np.log(np.where(target > 0, p, 1 - p) + 1e-9))

    g: Weights = {}
    d_logit = (p - target).astype(np.float32) / len(words)
    g["o"], g["ob"] = pooled.T @ d_logit, np.array([d_logit.sum()], np.float32)
    d_pooled = d_logit[:, None] * w["o"]
    d_weight = (states * d_pooled).sum(axis=2)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    d_seen = d_score[:, :, None] * w["a"] * (1 - seen * seen)
    flat = states.reshape(-1, 2 * _HIDDEN)
    g["a"] = seen.reshape(-1, _ATTENTION).T @ d_score.ravel()
    g["A"] = flat.T @ d_seen.reshape(-1, _ATTENTION)
    d_states = weight[:, :, None] * d_pooled + d_seen @ w["A"].T
    d_xf, g["Uf"] = gru_back(d_states[:, :, :_HIDDEN], w["Uf"], wf, None)
    d_xb, g["Ub"] = gru_back(d_states[::-1, :, _HIDDEN:], w["Ub"], wb, None)
    d_xb = d_xb[::-1]
    flat_x = x.reshape(-1, x.shape[2])
    for side, d in (("f", d_xf), ("b", d_xb)):
        d = d.reshape(-1, 3 * _HIDDEN)
        g[f"W{side}"], g[f"b{side}"] = flat_x.T @ d, d.sum(axis=0)
    d_x = (d_xf @ w["Wf"].T + d_xb @ w["Wb"].T).reshape(-1, x.shape[2])
    d_inputs = np.zeros_like(inputs)
    np.add.at(d_inputs, ids.ravel(), d_x)
    d_inputs[buckets == 0] = 0
    g["word"] = np.zeros_like(w["word"])
    np.add.at(g["word"], buckets, d_inputs[:, :_WORD_DIM])
    ends = np.zeros((*codes.shape, _CHAR_HIDDEN), np.float32)
    ends[-1] = d_inputs[:, _WORD_DIM : _WORD_DIM + _CHAR_HIDDEN]
    d_cf, g["cUf"] = gru_back(ends, w["cUf"], mf, mask)
    ends[-1] = d_inputs[:, _WORD_DIM + _CHAR_HIDDEN :]
    d_cb, g["cUb"] = gru_back(ends, w["cUb"], mb, mask[::-1])
    d_cb = d_cb[::-1]
    flat_c = letters.reshape(-1, _CHAR_DIM)
    for side, d in (("f", d_cf), ("b", d_cb)):
        d = d.reshape(-1, 3 * _CHAR_HIDDEN)
        g[f"cW{side}"], g[f"cb{side}"] = flat_c.T @ d, d.sum(axis=0)
    g["char"] = np.zeros_like(w["char"])
    np.add.at(g["char"], codes.ravel(), (d_cf @ w["cWf"].T + d_cb @ w["cWb"].T).reshape(-1, _CHAR_DIM))
    return float(loss), g


# --- windows and scores --------------------------------------------------------------------------


def tokens(text: bytes | None) -> list[bytes]:
    """Words with A-Z lowered, parted by ASCII white space."""
    return (text or b"").lower().split()


def window_starts(n: int) -> list[int]:
    """Starts of overlapping windows that cover n words; the last one ends with the text."""
    if n <= WINDOW:
        return [0]
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def _run(table: np.ndarray, steps: Iterator[np.ndarray], u: np.ndarray, out: Iterator[np.ndarray] | None = None) -> np.ndarray:
    """Last states of a GRU without masks; at each step the projected inputs are the rows ``steps`` of ``table``."""
    h, size = None, u.shape[0]
    for rows in steps:
        x = table.take(rows, axis=0)
        if h is None:
            h = np.zeros((len(rows), size), np.float32)
        a = h @ u
        gates = x[:, : 2 * size] + a[:, : 2 * size]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        n = a[:, 2 * size :] * gates[:, size:]
        n += x[:, 2 * size :]
        np.tanh(n, out=n)
        h -= n
        h *= gates[:, :size]
        h += n
        if out is not None:
            next(out)[:] = h
    return h


class Scorer:
    """Scores windows; the inputs of words are computed once per distinct word."""

    def __init__(self, w: Weights) -> None:
        self.w = w
        self.letters = {side: w["char"] @ w[f"cW{side}"] + w[f"cb{side}"] for side in "fb"}
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}  # rows of words as they stand in texts
        self.row: dict[bytes, int] = {}  # and without the signs around them
        self.inputs = {side: np.empty((1 << 14, 3 * _HIDDEN), np.float32) for side in "fb"}
        self._learn([b""])

    def _learn(self, words: list[bytes]) -> None:
        """Project the inputs of words that are new without the signs around them, those of about one length at once."""
        plain = {x: x.strip(_AROUND) for x in words}
        first = len(self.row)
        new = sorted({x for x in plain.values() if x not in self.row}, key=lambda x: (len(x), x))
        for place, x in enumerate(new):
            self.row[x] = first + place
        for side in "fb":
            room = len(self.inputs[side])
            if room < len(self.row):
                more = np.empty((max(room // 2, len(self.row) - room), 3 * _HIDDEN), np.float32)
                self.inputs[side] = np.concatenate((self.inputs[side], more))
        at = 0
        for length, same in groupby(new, key=len):
            same = list(same)
            for i in range(0, len(same), _WORDS_AT_ONCE):
                inputs = self._word_inputs(same[i : i + _WORDS_AT_ONCE], length)
                rows = slice(first + at, first + at + len(inputs))
                at += len(inputs)
                for side in "fb":
                    self.inputs[side][rows] = inputs @ self.w[f"W{side}"] + self.w[f"b{side}"]
        for x, stripped in plain.items():
            self.number[x] = self.row[stripped]

    def _word_inputs(self, words: list[bytes], length: int) -> np.ndarray:
        """Inputs of words of one length."""
        w = self.w
        inputs = np.zeros((len(words), _WORD_DIM + 2 * _CHAR_HIDDEN), np.float32)
        if length:
            codes = np.frombuffer(b"".join(words), np.uint8).reshape(-1, length).T
            inputs[:, :_WORD_DIM] = w["word"][[_bucket(x) for x in words]]
            inputs[:, _WORD_DIM : _WORD_DIM + _CHAR_HIDDEN] = _run(self.letters["f"], iter(codes), w["cUf"])
            inputs[:, _WORD_DIM + _CHAR_HIDDEN :] = _run(self.letters["b"], iter(codes[::-1]), w["cUb"])
        return inputs

    def ids(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        if len(self.number) > _REMEMBERED:
            self._forget()
        number = self.number
        new = {x for words in texts for x in words if x not in number}
        if new:
            self._learn(list(new))
        return [np.array([number[x] for x in words] or [0], np.int64) for words in texts]

    def logits(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Logit per window; ``ids`` is (windows, WINDOW)."""
        w, steps = self.w, np.ascontiguousarray(ids.T)
        batch = ids.shape[0]
        states = np.empty((WINDOW, batch, 2 * _HIDDEN), np.float32)
        _run(self.inputs["f"], iter(steps), w["Uf"], iter(states[:, :, :_HIDDEN]))
        _run(self.inputs["b"], iter(steps[::-1]), w["Ub"], iter(states[::-1, :, _HIDDEN:]))
        real = np.arange(WINDOW)[:, None] < np.maximum(1, lengths)
        pooled, _, _ = _pool(w, states, real)
        return pooled @ w["o"] + w["ob"][0]

    def window_logits(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Logits of all windows of all texts, and where each text's begin."""
        found, begins, total = [], [], 0
        pending: list[np.ndarray] = []
        lengths: list[int] = []
        for ids in self.ids(texts):
            starts = window_starts(len(ids))
            if len(ids) < WINDOW:
                pending.append(np.concatenate((ids, np.zeros(WINDOW - len(ids), np.int64)))[None])
            else:
                pending.append(ids[np.array(starts)[:, None] + np.arange(WINDOW)])
            lengths += [min(len(ids), WINDOW)] * len(starts)
            begins.append(total)
            total += len(starts)
        rows, lengths_ = np.concatenate(pending), np.array(lengths)
        for at in range(0, total, _WINDOWS_AT_ONCE):
            found.append(self.logits(rows[at : at + _WINDOWS_AT_ONCE], lengths_[at : at + _WINDOWS_AT_ONCE]))
        return np.concatenate(found), np.array(begins)


# --- training ------------------------------------------------------------------------------------


def _typical(texts: list[list[bytes]], toxic: np.ndarray) -> dict[bytes, float]:
    """How much more often a word occurs in toxic than in clean documents."""
    seen = [Counter(), Counter()]
    for words, y in zip(texts, toxic, strict=True):
        seen[int(y)].update({x.strip(_AROUND) for x in words})
    n = [max(1, (toxic == y).sum()) for y in (0, 1)]
    return {x: np.log((c + 0.5) / (n[1] + 1)) - np.log((seen[0][x] + 0.5) / (n[0] + 1)) for x, c in seen[1].items()}


def _as_window(words: list[bytes], start: int) -> list[bytes]:
    return [x.strip(_AROUND) for x in words[start : start + WINDOW]]


def train(texts: list[bytes], labels: list[int], seed: int = 7) -> tuple[Weights, tuple[float, float]] | None:
    """Weights and the (scale, shift) that turn a document's largest logit into that of its probability."""
    toxic = np.array(labels)
    if len(set(labels)) < 2:
        return None
    words = [tokens(t) for t in texts]
    # A fifth of the documents of each class is kept for the last fit.
    rank = np.empty(len(toxic), int)
    for y in (0, 1):
        rank[toxic == y] = np.arange((toxic == y).sum())
    fitting = rank % 5 != 4
    draw = np.random.default_rng(seed)
    typical = _typical([x for x, f in zip(words, fitting, strict=True) if f], toxic[fitting])
    w = initial_weights(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    count = 0
    for turn in range(ROUNDS):
        windows, target = [], []
        of = [i for i in range(len(words)) if fitting[i]]
        if turn:
            logits, begins = Scorer(w).window_logits([words[i] for i in of])
            ends = [*begins[1:], len(logits)]
        for k, i in enumerate(of):
            starts = window_starts(len(words[i]))
            if turn:
                best = np.argsort(-logits[begins[k] : ends[k]], kind="stable")
            elif toxic[i]:
                peak = [max((typical.get(x.strip(_AROUND), 0) for x in words[i][s : s + WINDOW]), default=0) for s in starts]
                best = np.argsort(-np.array(peak), kind="stable")
            else:
                best = draw.permutation(len(starts))
            for s in best[: 1 if toxic[i] else 2]:
                windows.append(_as_window(words[i], starts[s]))
                target.append(toxic[i])
        # Small samples are gone through more often.
        passes = max(1, round(STEPS * BATCH / len(windows)))
        order = np.concatenate([draw.permutation(len(windows)) for _ in range(passes)])
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            _, g = _step(w, [windows[i] for i in part], np.array([target[i] for i in part], np.float32))
            count += 1
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            rate = RATE * min(1.0, 5 / (norm + 1e-9)) * (0.7**turn)
            for k, grad in g.items():
                m, v = moments[k]
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                w[k] -= rate * (m / (1 - 0.9**count)) / (np.sqrt(v / (1 - 0.99**count)) + 1e-8)
    kept = [i for i in range(len(words)) if not fitting[i]] or of
    logits, begins = Scorer(w).window_logits([words[i] for i in kept])
    return w, _calibrated(np.maximum.reduceat(logits, begins), toxic[kept])


def _calibrated(logit: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic fit of labels on logits by Newton steps, held near (1, 0) by a weak prior.

    The sample has as many toxic documents as clean ones; they are weighed as ``TOXIC_SHARE`` of all.
    """
    x = np.stack((logit.astype(float), np.ones(len(logit))), axis=1)
    share = np.where(toxic > 0, TOXIC_SHARE / max(1, (toxic > 0).sum()), (1 - TOXIC_SHARE) / max(1, (toxic == 0).sum()))
    weight = share * len(toxic)
    start = np.array([1.0, 0.0])

    def loss(beta: np.ndarray) -> float:
        z = x @ beta
        return float((weight * (np.logaddexp(0, z) - toxic * z)).sum() + 0.5 * ((beta - start) ** 2).sum())

    beta = start.copy()
    for _ in range(25):
        p = _sigmoid(x @ beta)
        gradient = x.T @ (weight * (p - toxic)) + (beta - start)
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(2)
        step, size = np.linalg.solve(curvature, gradient), 1.0
        while size > 1e-4 and loss(beta - size * step) > loss(beta):
            size /= 2
        beta = beta - size * step
    return float(max(beta[0], 0.05)), float(beta[1])


def _scoring(model: object) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        scorer = Scorer(fitted[0]) if fitted else None
        for batch in batches:
            ids = [c for c in batch.schema.names if c != "text"]
            column = batch.column("text").cast(pa.large_binary())
            scores = []
            for at in range(0, batch.num_rows, 256):
                texts = [tokens(t) for t in column.slice(at, 256).to_pylist()]
                if scorer is None:
                    scores.append(np.full(len(texts), 0.5))
                    continue
                logits, begins = scorer.window_logits(texts)
                scale, shift = fitted[1]
                scores.append(_sigmoid(scale * np.maximum.reduceat(logits, begins).astype(float) + shift))
            score = np.concatenate(scores) if scores else np.empty(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ids), pa.array(score)], [*ids, "score"])

    return run


def labelled_sample(
    docs: DataFrame, labels: DataFrame, eligible: Column, per_class: int = SAMPLE_PER_CLASS, max_bytes: int = SAMPLE_BYTES
) -> tuple[list[bytes], list[int]]:
    """At most ``per_class`` labelled texts of each class, chosen by a hash of the id, and their labels.

    Of rows that share an id the least text is taken.
    """
    known = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic IS NOT NULL")
    # Lengths meet labels, not texts; then the few ids that were picked are looked up.
    lengths = docs.where(eligible).select("doc_id", F.octet_length("text").alias("bytes")).where(F.col("bytes") <= max_bytes)
    joined = lengths.select("doc_id").join(known, "doc_id").distinct().withColumn("place", F.xxhash64("doc_id"))
    picked = []
    for y in (0, 1):
        of_class = joined.where((F.col("toxic") >= 1) == F.lit(bool(y))).orderBy("place", "doc_id").limit(per_class)
        picked += [(r.doc_id, r.place, y) for r in of_class.select("doc_id", "place").collect()]
    if not picked:
        return [], []
    schema = f"wanted {docs.schema['doc_id'].dataType.simpleString()}, place bigint, toxic int"
    wanted = F.broadcast(docs.sparkSession.createDataFrame(picked, schema))  # at most two classes of per_class ids
    rows = docs.where(F.octet_length("text") <= max_bytes).join(wanted, F.col("doc_id") == F.col("wanted"))
    least = rows.groupBy("wanted", "place", wanted["toxic"]).agg(F.min("text").alias("text")).collect()
    least.sort(key=lambda r: (r.place, r.wanted))
    return [r.text.encode() for r in least], [r.toxic for r in least]


def toxicity_scores(docs: DataFrame, labels: DataFrame, eligible: Column) -> DataFrame:
    """``doc_id, score`` of every document; the network learns from labelled documents that are ``eligible``."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    model = docs.sparkSession.sparkContext.broadcast(train(*labelled_sample(docs, labels, eligible)))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_scoring(model), f"doc_id {id_type}, score double")
