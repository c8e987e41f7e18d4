import hashlib
import re

import pytest

from shelfprice.llm import exact_dedup


def brute(docs):
    """(doc_id, keep_id, group_size, kept, sha) of all rows, as a sorted list."""
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", text or "") for _, text in docs]
    groups = {}
    for at, text in enumerate(normal):
        groups.setdefault(text, []).append(at)
    order = lambda at: (docs[at][0] is None, docs[at][0] or 0, at)
    out = []
    for text, rows in groups.items():
        first = min(rows, key=order)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(docs[at][0], docs[first][0], len(rows), at == first, sha) for at in rows]
    return sorted(out, key=repr)


LONG = "a long text that goes on " * 2000
DOCS = [
    (5, "same text"), (3, "same \n\ttext"), (9, "same text "), (4, "Same text"), (1, "same text"), (2, ""), (6, None), (7, " "), (8, "\t\n"),
    (10, LONG), (11, LONG), (12, LONG + "x"), (13, LONG[:-2]), (14, "x" * 64), (15, "x" * 64), (16, "x" * 65), (17, "x" * 63), (18, "é" * 32), (19, "é" * 32),
    (20, "same text"), (20, "same text"), (None, "same text"), (None, "only here without id"), (None, "only here without id"), (None, None),
]


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


@pytest.mark.parametrize(("width", "growth", "broadcast"), [(64, 8, 100_000), (1, 2, 100_000), (3, 5, 0), (1 << 20, 2, 0)])
def test_against_brute_force(spark, width, growth, broadcast):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(5)
    assert rows(exact_dedup.exact_groups(docs, width, growth, broadcast)) == brute(DOCS)


def test_the_test_table(spark, table):
    docs = table("documents")
    assert rows(exact_dedup.exact_groups(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_a_hot_group(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, repeat('hot ', 300), concat(repeat('hot ', 200), id % 700)) AS text")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert rows(exact_dedup.exact_groups(docs, max_broadcast_rows=0)) == want


def test_kept_documents(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS node", "3 AS digit", "4 AS going")
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    normal = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    assert len(got) == len({normal(t) for _, t in DOCS})
    assert sorted((i, normal(t)) for i, t in got if i is not None) == sorted(
        (i, normal(t)) for i, t in {normal(t): (i, t) for i, t in sorted((d for d in DOCS if d[0] is not None), reverse=True)}.values()
    )


def test_empty_table_and_text_ids(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0 and exact_dedup.keep_first(docs.limit(0)).count() == 0
    named = docs.selectExpr("concat('d', doc_id) AS doc_id", "text").where("doc_id IN ('d5', 'd3', 'd20')")
    assert sorted({(r.keep_id, r.group_size) for r in exact_dedup.exact_groups(named).collect()}) == [("d20", 4)]
