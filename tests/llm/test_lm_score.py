import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfprice.llm import lm_score

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def brute_base(docs, training):
    counts = Counter()
    for i, text in docs:
        if training(i):
            counts.update(words_of(text))
    n, v = sum(counts.values()), len(counts)
    base = lambda t: sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words_of(t))
    return [(i, base(t), len(words_of(t)), sum(w in counts for w in words_of(t)), n) for i, t in docs]


def scores(spark, docs, training):
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS word", "3 AS n_bytes")
    return lm_score.lm_scores(df, training).collect()


def key(row):
    return (row[0] is None, row[0] or 0, row[2], row[1])


@pytest.mark.parametrize("listed", [3, 50, 1 << 18])
def test_base_score_with_any_number_of_listed_words(spark, monkeypatch, listed):
    monkeypatch.setattr(lm_score, "LISTED", listed)
    draw = random.Random(4)
    docs = [(i, " ".join(f"W{int(draw.paretovariate(0.6))}" for _ in range(draw.randrange(60)))) for i in range(60)]
    docs += [(None, "w1 w2"), (100, None), (101, ""), (102, "only new words né né"), (102, "only new words né né"), (103, "w1 " * 5000)]
    got = scores(spark, docs, F.col("doc_id") % 3 != 1)
    want = brute_base(docs, lambda i: i is not None and i % 3 != 1)
    got = sorted(((r.doc_id, r.base_score, r.n_tokens, r.n_known, r.train_tokens) for r in got), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, sorted(want, key=key), strict=True):
        assert (g[0], g[2:]) == (w[0], w[2:]) and g[1] == pytest.approx(w[1], abs=1e-9)


def test_the_model_beats_the_base_on_held_out_documents(spark):
    """Texts of two languages, whose words follow each other in pairs."""
    draw = random.Random(8)
    docs = []
    for i in range(600):
        lang = "ab"[i % 2]
        docs.append((i, " ".join(f"{lang}{(x := draw.randrange(40))} {lang}{x + 40}" for _ in range(60))))
    rows = scores(spark, docs, F.col("doc_id") % 7 != 2)
    held = [r for r in rows if r.doc_id % 7 == 2]
    assert sum(r.score for r in held) > 0.75 * sum(r.base_score for r in held)
    for r in rows:
        n_bytes = len(dict(docs)[r.doc_id].encode())
        assert r.bits_per_byte == pytest.approx(-r.score * math.log2(10) / (n_bytes + 1))


def test_without_training_documents(spark):
    rows = scores(spark, [(1, "a b"), (2, None)], F.lit(False))
    assert [(r.base_score, r.n_known, r.train_tokens) for r in rows] == [(0.0, 0, 0)] * 2
    assert all(r.score <= 1e-9 for r in rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm_score.lm_scores(empty, F.lit(True)).count() == 0


def model_of(counts, other=5):
    code = lm_score.Code([f"w{i}".encode() for i in range(len(counts))], counts, other)
    return lm_score.Model(code)


def test_probabilities_of_a_token_add_up():
    """Whatever was learned and read before, the next token is one of the leaves."""
    model = model_of([500 // (i + 1) for i in range(200)])
    draw = np.random.default_rng(0)
    model.read([draw.integers(0, 201, 300) for _ in range(60)], learn=True)
    for before in ([], [3], [7, 150, 2]):
        docs = [np.array([*before, x]) for x in range(201)]
        prefix = model.read([np.array(before)], learn=False)[0] if before else 0.0
        total = np.exp2(model.read(docs, learn=False) - prefix).sum()
        assert total == pytest.approx(1, abs=1e-3)


def test_code_is_complete():
    code = model_of([9, 5, 3, 3, 1, 1]).code
    assert sum(2.0 ** -code.length.astype(float)) == 1
    weights = np.array([9, 5, 3, 3, 1, 1, 5])
    for i in range(7):
        way = slice(code.offset[i], code.offset[i] + code.length[i])
        p = 1 / (1 + np.exp(-code.stretched[code.node[way]] * (2 * code.bit[way] - 1)))
        assert p.prod() == pytest.approx(weights[i] / weights.sum(), rel=1e-5)
        assert code.node[way][0] == 0 and list(code.node[way]) == sorted(code.node[way])


def test_pieces_of_models_add_up():
    a, b = model_of([8, 4, 2]), model_of([8, 4, 2])
    a.read([np.array([0, 1, 2, 3] * 20)], learn=True)
    b.read([np.array([3, 2, 1] * 20)], learn=True)
    sums = {}
    for number, data in [*a.pieces(), *b.pieces()]:
        sums[number] = sums.get(number, 0) + lm_score._values(number, data, np.float32).astype(np.float64)
    both = model_of([8, 4, 2]).load({k: v.tobytes() for k, v in sums.items()})
    assert np.array_equal(both.counts, a.counts + b.counts) and np.array_equal(both.seen, a.seen + b.seen)
    share = a.seen.sum() / (a.seen.sum() + b.seen.sum())
    assert np.allclose(both.weights, share * a.weights + (1 - share) * b.weights, atol=1e-6)


def plain_score(code, documents, text, bits):
    """The score of one text after reading some, bit by bit with dictionaries and the rules in words."""
    stretch = lambda n: math.log(n[1] + 0.4) - math.log(n[0] + 0.4)
    sure = lambda n: sum(float(sum(n)) > least for least in (0, 3, 30))
    model = lm_score.Model(code, bits)
    model.read(documents, learn=True)
    weights, seen, set_ = model.weights.astype(float), model.seen, model.set
    counts = model.counts
    own, score = [0.0] * 5, 0.0
    history = []
    for token in text:
        prev = [code.unlisted + 1] * 2
        prev[: len(history[-2:])] = history[::-1][:2]
        common = next((t for t in reversed(history) if t < lm_score.COMMON), lm_score.COMMON)
        history.append(token)
        m32 = (1 << 32) - 1
        word = (prev[0] + 1) * 0x9E3779B1 & m32
        two = word ^ ((prev[1] + 7) * 0x85EBCA6B & m32)
        for k in range(code.length[token]):
            node, bit = int(code.node[code.offset[token] + k]), float(code.bit[code.offset[token] + k])
            mixed = node * 0xC2B2AE35 & m32
            table, shift = 1 << bits, 32 - bits
            first = common * model.direct + node if node < model.direct else model.first + (((common * 0x9E3779B1 + mixed) * 0x85EBCA6B & m32) >> shift)
            slots = [first, model.first + table + (((word + mixed) * 0x27D4EB2F & m32) >> shift), model.first + 2 * table + (((two + mixed) * 0x165667B1 & m32) >> shift)]
            inputs = [float(code.stretched[node]), *(stretch(counts[s]) for s in slots), 0.3]
            depth = min(k >> 1, 7)
            gate = (depth * 4 + sure(counts[slots[1]])) * 4 + sure(counts[slots[2]])
            s = max(-12, min(12, sum(x * (weights[i][gate] + own[i]) for i, x in enumerate(inputs))))
            p = 1 / (1 + math.exp(-s))
            cell = round((s + 12) * 32 / 24) + depth * 33
            mapped = (24 * p + set_[cell]) / (24 + seen[cell])
            refined = (p + mapped) / 2
            score += math.log2(refined if bit else 1 - refined)
    return score


def test_a_short_text_by_hand():
    """Vectors over many documents give what the rules give bit by bit."""
    draw = random.Random(5)
    code = lm_score.Code([f"w{i}".encode() for i in range(90)], [400 // (i + 1) + 1 for i in range(90)], 7)
    read = [np.array([draw.randrange(91) for _ in range(200)]) for _ in range(30)]
    texts = [[3, 80, 3, 90, 12], [70], [0, 1, 2, 3, 4, 5, 66, 66, 66]]
    model = lm_score.Model(code, 12)
    model.read(read, learn=True)
    got = model.freeze().read([np.array(t) for t in texts], learn=False)
    for g, text in zip(got, texts, strict=True):
        assert g == pytest.approx(plain_score(code, read, text, 12), rel=1e-4)


def test_rare_words_that_follow_each_other(spark):
    """Twenty thousand words of equal count that come in pairs: the second is told by the first."""
    draw = random.Random(11)
    docs = [(i, " ".join(f"a{x} b{x}" for x in (draw.randrange(10_000) for _ in range(60)))) for i in range(3000)]
    rows = scores(spark, docs, F.col("doc_id") % 7 != 2)
    held = [r for r in rows if r.doc_id % 7 == 2]
    tokens = sum(r.n_tokens for r in held)
    assert sum(r.base_score for r in held) / tokens < -4 and sum(r.score for r in held) / tokens > -3.3


BLANK_TEXTS = ["  A  b\t", None, "", " \n", "x\x0by\x0cz\x1cw\x85 É\xa0ß", *(f"W{i} x  Y{i}" for i in range(9)), "last\r"]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
@pytest.mark.parametrize("first, n", [(0, 15), (3, 7), (5, 9), (6, 4), (2, 0)])
def test_tokens_of_a_slice(kind, first, n):
    """Slices of a batch give their own words, with or without NULLs in them."""
    words, each = lm_score.tokens(pa.array(BLANK_TEXTS, kind).slice(first, n))
    want = [(t or "").encode().lower().split() for t in BLANK_TEXTS[first : first + n]]
    assert words.to_pylist() == [w for ws in want for w in ws] and each.tolist() == [len(ws) for ws in want]


@pytest.mark.parametrize("listed", [[], [b"w", b"", b"x"], [b"w", b"x"]])
def test_tails_hold_each_unlisted_word_once(listed):
    texts = ["w new x new w é", "", None, "x", "w other", "new"]
    code = lm_score.Code(listed, [1] * len(listed), 1)
    words, n = lm_score.tokens(pa.array(texts))
    ids = lm_score._numbers(code, words, n)
    got = [{e["word"]: e["n"] for e in tail} for tail in lm_score._tails(code, words, n, ids).to_pylist()]
    for tail, text in zip(got, texts, strict=True):
        rare = Counter(w for w in [*(text or "").encode().split(), b""] if w not in listed)
        assert tail == (rare | {None: 1} if rare else {})


def test_parts_of_batches_are_whole_groups(monkeypatch):
    monkeypatch.setattr(lm_score, "_TEXT", 1000)
    batch = pa.RecordBatch.from_pydict({"text": [f"{i} " * 2 for i in range(1500)]})
    parts = list(lm_score._parts(iter([batch, batch.slice(0, 0), batch.slice(7, 3)])))
    assert all(len(p) % lm_score._TAKEN == 0 for p in parts[:-2]) and len(parts) > 4
    assert pa.Table.from_batches(parts) == pa.Table.from_batches([batch, batch.slice(7, 3)])


def test_reading_side_by_side_saves_passes_and_changes_nothing(monkeypatch):
    """A pass over the predictors takes the documents of two learned groups; scores are those of each document by itself."""
    model = model_of([500 // (i + 1) for i in range(200)])
    draw = np.random.default_rng(1)
    model.read([draw.integers(0, 201, 300) for _ in range(60)], learn=True)
    model.freeze()
    docs = [draw.integers(0, 201, lm_score.SEGMENT) for _ in range(2 * lm_score.SIDE_BY_SIDE)] + [np.array([3])]
    alone = [model.read([d], learn=False)[0] for d in docs]
    calls, whole = [], lm_score.Model._bits
    monkeypatch.setattr(lm_score.Model, "_bits", lambda *a: (calls.append(1), whole(*a))[1])
    assert model.read(docs, learn=False) == pytest.approx(alone, rel=1e-6)
    assert len(calls) == 2


def test_counts_beyond_the_table_of_logarithms():
    size = lm_score._LOGGED
    counts = np.array([[0, 1, size - 1], [size, 5 * size, 2]], np.float32)
    assert np.array_equal(lm_score._logs(counts), np.log(counts + np.float32(0.4)))
