import re
from itertools import permutations

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfprice.llm import filter_audit


def failing(docs):
    """Letters that each row fails, by the words of the contract."""
    out = []
    for doc_id, text, _ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        earlier = doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in docs)
        capitals = len(re.findall("[A-Z]", text))
        checks = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * capitals > 2 * len(text), bool(re.search("[#$%&*|]", text)), earlier]
        out.append({x for x, fails in zip("ABCDE", checks, strict=True) if fails})
    return out


def brute(docs, labels):
    """Filters applied one after another to lists of rows."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails = failing(docs)
    out = {}
    for part in {s or "" for _, _, s in docs}:
        here = [at for at, d in enumerate(docs) if (d[2] or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = here
            for step, name in enumerate(order, 1):
                gone = [at for at in left if name in fails[at]]
                left = [at for at in left if name not in fails[at]]
                total[name] += len(gone)
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(name in fails[at] for at in here) - len(gone), sum(fails[at] == {name} for at in here),
                    sum(docs[at][0] in good for at in gone), sum(docs[at][0] in toxic for at in gone),
                )
        for key in [k for k in out if k[0] == part]:
            out[key] += (total[key[1][key[2] - 1]],)
    return out


def found(df):
    rows = df.collect()
    assert len({(r.part, r.filter_order, r.step) for r in rows}) == len(rows)
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}


WORDS = " ".join(f"w{i}" for i in range(210))
DOCS = [
    (1, WORDS, "a"), (2, WORDS, "b"), (2, WORDS, "b"), (3, "short", "a"), (4, "SHORT # x x x x", None), (5, None, "a"), (6, "", "a"), (7, "x " * 300, ""),
    (None, WORDS, "a"), (None, "short", None), (8, "Ab " + WORDS, "c"), (9, WORDS + " $", "c"), (10, "ABCDEF " * 300, "c"), (11, "y " * 150_000, "b"), (12, WORDS + "\x0b\x85", "c"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, None, 1), (4, 1, 1), (8, 1, 1), (10, 0, 1), (99, 1, 1), (None, 1, 1)]


def frames(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, source string"), spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def test_against_brute_force(spark, monkeypatch):
    docs, labels = frames(spark)
    want = brute(DOCS, LABELS)
    assert found(filter_audit.audit_documents(docs, labels)) == want
    extra = docs.selectExpr("*", "1 AS part", "2 AS digest", "true AS good", "3 AS mask", "4 AS first")
    assert found(filter_audit.audit_documents(extra, labels.selectExpr("*", "1 AS good"))) == want
    monkeypatch.setattr(filter_audit, "attach_groups", lambda rows, groups, on: filter_audit_joins(rows, groups, on))
    assert found(filter_audit.audit_documents(docs, labels)) == want


def filter_audit_joins(rows, groups, on):
    from shelfprice.plans.joins import attach_groups

    return attach_groups(rows, groups, on, max_broadcast_rows=0)


def test_the_test_table(spark, table):
    docs = [(r.doc_id, r.text, r.source) for r in table("documents").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in table("labels").collect()]
    assert found(filter_audit.audit_documents(table("documents"), table("labels"))) == brute(docs, labels)


def test_empty_tables(spark):
    docs, labels = frames(spark)
    assert filter_audit.audit_documents(docs.limit(0), labels).count() == 0
    assert found(filter_audit.audit_documents(docs, labels.limit(0))) == brute(DOCS, [])


def test_other_filters(spark):
    rows = spark.range(100).withColumn("part", F.when(F.col("id") < 90, "x"))
    got = found(filter_audit.audit(rows, {"P": F.col("id") % 2 == 0, "Q": F.col("id") % 3 == 0}, F.col("part"), F.col("id") % 5 == 0, F.lit(None)))
    assert got["x", "PQ", 1] == (45, 45, 0, 30, 9, 0, 75)
    assert got["x", "PQ", 2] == (30, 15, 15, 15, 3, 0, 45)
    assert got["", "QP", 2] == (3, 3, 2, 3, 0, 0, 8)
    assert len(got) == 8


@given(st.lists(st.tuples(st.integers(0, 15), st.integers(0, 5), st.integers(0, 5), st.integers(0, 5)), max_size=16))
def test_walk_counts_survivors(cells):
    table = np.zeros((16, 3), np.int64)
    for mask, *counts in cells:
        table[mask] = counts
    stored = filter_audit.gray_walk(table, 4)
    for state in range(16):
        assert (stored[state] == table[[m for m in range(16) if not m & state]].sum(axis=0)).all()
