import hashlib
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfprice.llm import fim


def brute(doc_id, text, rate=100, spm=50, seed=7):
    """The contract by regular expression and slices of lines."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(lines)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return text, "plain", n, None, None
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h4 % 100 < spm:
        return f"<S>{suffix}<P>{prefix}<M>{middle}", "spm", n, len(prefix), len(middle)
    return f"<P>{prefix}<S>{suffix}<M>{middle}", "psm", n, len(prefix), len(middle)


@given(st.text(alphabet="a\né\r<SPM>\U0001f600", max_size=40), st.integers(0, 200))
def test_transform_and_back(text, doc_id):
    output, form, n, cut1, cut2 = fim.transform(text.encode(), str(doc_id), 7, 100, 50)
    want = brute(doc_id, text)
    assert (output.decode(), form, n) == want[:3]
    assert fim.restore_text(output, form) == text.encode()
    if form != "plain":
        assert (len(text.encode()[:cut1].decode()), len(text.encode()[cut1:cut2].decode())) == want[3:]


@given(st.binary(max_size=30), st.data())
def test_rotation(content, data):
    a, b, c = sorted(data.draw(st.integers(0, len(content))) for _ in range(3))
    buffer = bytearray(content)
    fim.rotate(buffer, a, b, c)
    assert buffer == content[:a] + content[b:c] + content[a:b] + content[c:]


DOCS = [
    (1, "one\ntwo\nthree"), (2, "one\n\n\n"), (3, ""), (4, None), (5, "has <S> in it\nand more"), (None, "a\nb\nc\nd\n"), (None, "a\nb\nc\nd\n"),
    (6, "\n"), (7, "ends with <\nS> or <P\n>"), (8, "long line é\n" * 40_000), (8, "same id\nother text"), (9, "no feed"),
]


@pytest.mark.parametrize(("rate", "spm", "seed"), [(100, 50, 7), (40, 50, 7), (100, 0, 1), (100, 100, 2), (0, 50, 7)])
def test_against_brute_force(spark, rate, spm, seed):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    made = fim.restore(fim.fill_in_middle(docs, seed, rate, spm))
    got = sorted((tuple(r) for r in made.select("doc_id", "output", "form", "n", "prefix_chars", "middle_chars", "restored").collect()), key=repr)
    assert got == sorted(((i, *brute(i, t, rate, spm, seed), t or "") for i, t in DOCS), key=repr)


def test_the_test_table(spark, table):
    docs = table("documents").select("doc_id", "text")
    rows = fim.restore(fim.fill_in_middle(docs)).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert {r.doc_id: r.restored for r in rows} == texts
    assert {r.form for r in rows} == {"psm", "spm"}
    for r in rows:
        assert (r.output, r.form, r.n, r.prefix_chars, r.middle_chars) == brute(r.doc_id, texts[r.doc_id])


def test_clashing_names_and_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 AS output", "2 AS form", "3 AS rest", "'x' AS `a b`", "4 AS restored")
    made = fim.fill_in_middle(docs)
    assert made.columns == ["doc_id", "output", "form", "rest", "a b", "restored", "_output", "_form", "n", "prefix_chars", "middle_chars"]
    back = fim.restore(made, "_output", "_form")
    assert back.columns == [*made.columns, "_restored"]
    assert sorted(r[0] for r in back.select("_restored").collect()) == sorted(t or "" for _, t in DOCS)
    assert {r.output for r in back.select("output").collect()} == {1}
    assert fim.restore(fim.fill_in_middle(docs.limit(0)), "_output", "_form").count() == 0


def test_large_texts_leave_in_parts(spark, monkeypatch):
    monkeypatch.setattr(fim, "OUT_BYTES", 10)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").coalesce(1)
    made = fim.restore(fim.fill_in_middle(docs))
    assert made.where(F.col("restored").isNull()).count() == 0 and made.count() == len(DOCS)


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("SELECT 1 AS doc_id, CAST(X'ff0a41fe0a' AS STRING) AS text")
    made = fim.restore(fim.fill_in_middle(docs)).select(F.hex(F.col("restored").cast("binary"))).first()
    assert made[0] == "FF0A41FE0A"
