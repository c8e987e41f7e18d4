import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfprice.llm import toxicity


def made(n, seed, first=0):
    """Documents of invented words; toxic ones hold words that begin with one of two roots."""
    draw = random.Random(seed)
    syllables = "ba be bi bo du da de di do".split()
    word = lambda: "".join(draw.choices(syllables, k=draw.randrange(1, 4)))
    docs = []
    for i in range(n):
        words = [word() for _ in range(draw.randrange(5, 150))]
        if i % 2:
            for _ in range(draw.randrange(1, 4)):
                words.insert(draw.randrange(len(words)), draw.choice(("zort", "kwix")) + word())
        docs.append((first + i, " ".join(words), i % 2))
    return docs


def test_gradients():
    w = {k: v.astype(np.float64) for k, v in toxicity.initial_weights().items()}
    words, y = [[b"idiot", b"the", b"", b"abc"], [b"x", b"yy", b"the"] * 5], np.array([1.0, 0.0])
    _, g = toxicity._step(w, words, y)
    for k, grad in g.items():
        at = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        keep, e = w[k][at], 1e-4
        w[k][at] = keep + e
        up = toxicity._step(w, words, y)[0]
        w[k][at] = keep - e
        down = toxicity._step(w, words, y)[0]
        w[k][at] = keep
        assert grad[at] == pytest.approx((up - down) / (2 * e), rel=0.02, abs=1e-5)


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 48, 49, 1000])
def test_windows_overlap_and_cover(n):
    starts = toxicity.window_starts(n)
    covered = {i for s in starts for i in range(s, min(n, s + toxicity.WINDOW))}
    assert covered == set(range(n)) and all(b - a <= toxicity.STRIDE for a, b in zip(starts, starts[1:], strict=False))


def test_scoring_agrees_with_the_training_network(monkeypatch):
    w = toxicity.initial_weights(3)
    windows = [[b"a", b"bc"], [f"w{i}".encode() for i in range(toxicity.WINDOW)], []]
    monkeypatch.setattr(toxicity, "_REMEMBERED", 5)
    scorer = toxicity.Scorer(w)
    for _ in range(2):
        logits, begins = scorer.window_logits([[x + b"," for x in v] for v in windows])
        assert list(begins) == [0, 1, 2]
        for v, logit in zip(windows, logits, strict=True):
            losses = [toxicity._step(w, [v], np.array([y]))[0] for y in (0.0, 1.0)]
            assert logit == pytest.approx(losses[0] - losses[1], abs=1e-3)


@pytest.fixture(scope="module")
def scored(spark):
    train, test = made(500, 1), made(200, 2, first=10_000)
    odd = [(20_000, None, 0), (20_001, "", 0), (20_002, " \n", 0), (20_002, " \n", 0), (None, "ba be", 0), (20_003, "ba bo du " * 30_000 + "zortba", 1)]
    docs = spark.createDataFrame([d[:2] for d in train + test + odd], "doc_id long, text string").withColumn("score", F.lit(7))
    labels = [(d[0], d[2]) for d in train + test + odd] + [(0, None), (1, 1), (99_999, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    rows = toxicity.toxicity_scores(docs, labels, F.col("doc_id") < 10_000).collect()
    assert len(rows) == len(train + test + odd)
    return {r.doc_id: r.score for r in rows}, test


def test_held_out_documents_are_told_apart(scored):
    scores, test = scored
    right = sum((scores[i] >= 0.7) == bool(y) for i, _, y in test)
    assert right >= 0.93 * len(test)


def test_odd_rows(scored):
    scores, _ = scored
    assert all(0 <= s <= 1 for s in scores.values()) and scores[20_000] == scores[20_001] == scores[20_002] < 0.7
    assert scores[20_003] >= 0.7  # one bad word behind 90 000 others


def test_without_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, "a"), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert [r.score for r in toxicity.toxicity_scores(docs, labels, F.lit(True)).collect()] == [0.5, 0.5]
    assert toxicity.toxicity_scores(docs.limit(0), labels, F.lit(True)).count() == 0
