from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shelfprice.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, open_, target = sum(sizes.values()), set(names), {}
    while open_:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return target | share
        target |= {s: most * sizes[s] for s in over}
        open_ -= over
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 10, "c": 10, None: 10},
        {"a": 1, "b": 1000, "c": 5, "d": 300, "e": 2, "é": 0},
        {"z": 7},
        {"a": 0, "b": 0},
        {f"s{i:03}": (i * 37) % 101 for i in range(60)},
    ],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def check(rows, sizes):
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        assert r.size == 0 or abs(r.copies - r.target / r.source_size) < 1
        taken[r.source] += r.taken
    return taken


def test_mix_of_the_test_table(spark, table):
    docs = table("documents")
    rows = mixing.mix(docs).collect()
    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r.source] += len((r.text or "").split())
    target = brute_targets(sizes)
    taken = check(rows, sizes)
    largest = max(r.size for r in rows)
    for source, words in taken.items():
        assert abs(words - target[source]) <= largest
    assert len(rows) == docs.count()
    again = mixing.mix(docs.repartition(7, "text")).collect()
    key = lambda r: (r.doc_id, r.source, r.taken)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_many_levels_come_near_their_targets(spark):
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 5) END AS source",
        "repeat('w ', cast(1 + (id * 7919) % 400 as int)) AS text",
    )
    rows = mixing.mix(docs, block=8).collect()
    target = {r.source: r.target for r in rows}
    taken = check(rows, {r.source: r.source_size for r in rows})
    assert all(abs(words / target[s] - 1) < 0.005 for s, words in taken.items())


def test_expected_copies_are_kept(spark):
    """Over many documents of one size the share of copies is the probability."""
    units = spark.range(4000).selectExpr("'s' AS source", "cast(id AS string) AS id", "10.0D AS size", "3.0D AS mass")
    copies = mixing.pivotal_copies(units, block=16).collect()
    assert len(copies) == 4000 and sum(r["copy"] for r in copies) == 1200
    first = sum(r["copy"] for r in copies if int(r["id"]) < 2000)
    assert 520 < first < 680


def test_giants_do_not_stay_over(spark):
    data = [(0, "a", "w " * 5000)] + [(i, "a", "w " * 100) for i in range(1, 181)] + [(1000 + i, "b", "w " * 50) for i in range(100)]
    rows = mixing.mix(spark.createDataFrame(data, "doc_id long, source string, text string"), weights=(1, 1)).collect()
    taken = check(rows, {"a": 23000, "b": 5000})
    assert abs(taken["a"] - 14_000) <= 100 and abs(taken["b"] - 14_000) <= 50


def test_odd_rows(spark):
    data = [(1, None, None), (1, None, "a b"), (2, "x", ""), (3, "x", "a b c"), (3, "x", "a b c"), (None, "x", "q"), (3, "y", "a b c")]
    docs = spark.createDataFrame(data, "doc_id long, source string, text string").withColumn("size", F.lit("?")).withColumn("copies", F.lit(9))
    rows = mixing.mix(docs).collect()
    assert len(rows) == 7 and sorted(r.size for r in rows) == [0, 0, 1, 2, 3, 3, 3]
    check(rows, {None: 2, "x": 7, "y": 3})
    assert mixing.mix(docs.limit(0)).count() == 0
    assert [r.taken for r in mixing.mix(docs.where("text = ''")).collect()] == [0]


def test_no_id_is_not_the_id_null(spark):
    data = [(doc_id, "x", "a b c") for doc_id in (None, "null", "#1", "=", "1#1", "1")] * 3 + [(None, None, "a b c")]
    docs = spark.createDataFrame(data, "doc_id string, source string, text string")
    rows = mixing.mix(docs).collect()
    assert sorted((r.doc_id or "", r.source or "") for r in rows) == sorted((i or "", s or "") for i, s, _ in data)
    check(rows, {"x": 54, None: 3})


def test_many_alike_are_numbered_by_several_tasks(spark):
    counted = spark.createDataFrame([("a", None, 3, 25), ("a", 1, 3, 1), ("b", 2, 4, 10)], "source string, doc_id long, size long, rows long")
    got = sorted((r.source, r.doc_id or 0, r.row) for r in mixing._numbered(counted, 10).collect())
    assert got == sorted([("a", 0, i) for i in range(1, 26)] + [("a", 1, 1)] + [("b", 2, i) for i in range(1, 11)])


def test_the_miss_is_a_small_document(spark):
    """Sizes from 20 to 9000 words: a large one left over would miss by far more than the median."""
    docs = spark.range(1500).selectExpr(
        "id AS doc_id", "concat('s', id % 3) AS source", "repeat('w ', cast(20 + 9000 * pow((id * 7919 % 1500) / 1500.0, 8) as int)) AS text"
    )
    rows = mixing.mix(docs, weights=(3, 2, 2)).collect()
    target, sizes = {r.source: r.target for r in rows}, {r.source: r.source_size for r in rows}
    median = {s: sorted(r.size for r in rows if r.source == s)[250] for s in sizes}
    for source, words in check(rows, sizes).items():
        assert abs(words - target[source]) <= median[source]


def test_expected_copies_of_giants_are_kept(spark):
    """Sources of three unlike documents, each wanted at three tenths: over many sources every place gets its share."""
    sizes = (50, 30, 20)
    docs = [(s * 10 + i, f"s{s:04}", "w " * n) for s in range(800) for i, n in enumerate(sizes)] + [(99_999, "t", "w " * 24_130)]
    rows = mixing.mix(spark.createDataFrame(docs, "doc_id long, source string, text string"), weights=(1,)).collect()
    assert {round(r.target / r.source_size, 9) for r in rows if r.source != "t"} == {1.3}
    for size in sizes:
        copies = [r.copies for r in rows if r.size == size]
        assert set(copies) == {1, 2} and abs(sum(copies) / 800 - 1.3) < 0.06
