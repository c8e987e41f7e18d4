import re

import pytest
from pyspark.sql import functions as F

from shelfprice.llm import line_dedup


def brute(docs, pattern=r"\n", min_words=5):
    """Texts with every later unit of a kind left out, documents in the order of their ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        kept, at = [], 0
        for part in re.split(f"({pattern})", text or ""):
            kept.append(part)
        units, marks = kept[::2], ["", *kept[1::2]]
        text = ""
        for i, unit in enumerate(units):
            words = unit.encode().lower().split()
            if len(words) >= min_words:
                if tuple(words) in seen:
                    continue
                seen.add(tuple(words))
            text += (marks[i] if at else "") + unit
            at += 1
        out[doc_id] = text
    return out


LINE = "five words make a line here"
DOCS = [
    (1, f"{LINE}\nother\n{LINE.upper()}"), (2, f"  FIVE words\tmake a line here \n\nshort\nshort"), (3, LINE), (4, f"{LINE}\n"),
    (5, ""), (6, "no line breaks but quite a few words " * 3000), (7, f"keep\n{LINE}\nkeep"), (8, f"\n{LINE}"),
]


@pytest.mark.parametrize("pattern", [line_dedup.LINE, line_dedup.PARAGRAPH])
def test_against_brute_force(spark, pattern):
    docs = [*DOCS, (9, f"{LINE}\nmore of it\n \nnext {LINE}\n\n\n{LINE}\nmore of it")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.remove_repeats(df, pattern, min_words=5, window=None).collect()}
    assert got == brute(docs, pattern)


def test_the_test_table(spark, table):
    docs = table("documents")
    kept = line_dedup.remove_repeats(docs, min_words=5, window=None)
    assert kept.columns == [*docs.columns, "removed"]
    old = {r.doc_id: r.text for r in docs.collect()}
    rows = kept.collect()
    assert {r.doc_id: r.text for r in rows} == brute(old.items())
    spans = [(r.doc_id, s) for r in rows for s in r.removed]
    assert spans
    for doc_id, s in spans:
        assert old[doc_id].split("\n")[s.unit] == old[doc_id][s.start : s.end]


def test_odd_rows(spark):
    data = [(1, LINE), (1, LINE), (None, LINE), (None, LINE), (None, None), (2, None), (3, LINE)]
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 AS removed", "2 AS hash", "3 AS row", "4 AS unit")
    lines = lambda df: line_dedup.remove_repeats(df, min_words=5, window=None)
    out = lines(docs)
    assert out.columns == [*docs.columns, "_removed"]
    texts = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert texts == sorted([(1, ""), (1, ""), (None, LINE), (None, ""), (None, None), (2, None), (3, "")], key=repr)
    assert lines(docs.limit(0)).count() == 0 and line_dedup.remove_repeats(docs.limit(0)).count() == 0
    assert sorted(r.text for r in lines(docs.where(F.col("doc_id") == 1)).collect()) == ["", LINE]


def passages(docs, window):
    """Texts without the words of every repeated run that is not the earliest of its kind, looked up run by run."""
    cut = {i: [re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", line) for line in (text or "").split("\n")] for i, text in docs}
    words = {i: [w.strip(" \t\n\v\f\r").encode().lower() for line in lines for w in line] for i, lines in cut.items()}
    first, gone = {}, {i: set() for i in cut}
    for i in sorted(cut):
        for at in range(len(words[i]) - window + 1):
            j, start = first.setdefault(tuple(words[i][at : at + window]), (i, at))
            if j != i or at >= start + window:
                gone[i].update(range(at, at + window))
    out = {}
    for i, text in docs:
        kept, at = [], 0
        for line, tokens in zip((text or "").split("\n"), cut[i], strict=True):
            left = [w for k, w in enumerate(tokens, at) if k not in gone[i]]
            at += len(tokens)
            if left or not tokens:
                kept.append("".join(left) + line[len("".join(tokens)) :])
        out[i] = "\n".join(kept) if text is not None else None
    return out


def said(seed, n):
    return " ".join(f"{'abcdef'[(seed * 7 + k * k) % 6]}{(seed * 31 + k * 17) % 97}" for k in range(n))


P = said(1, 55)
PLANTED = [
    (1, f"{said(2, 30)} {P} {said(3, 20)}\n{said(4, 12)}"), (2, f"{P} {said(5, 40)}"), (3, f"{said(6, 9)}\n{said(7, 33)} {P}"), (4, f"{said(8, 5)}\n{P.upper()}\n{said(9, 5)}"),
    (5, f"{said(10, 8)} {' '.join(P.split()[:30])}\n{' '.join(P.split()[30:])} {said(11, 8)}"), (6, f"  {P}  and {P}\t{P}"), (7, said(12, 10) + " " + " ".join(P.split()[:49]) + " no more of it"), (8, "and " * 400),
    (9, f"{said(13, 70)}\n{said(14, 6)}"), (10, f"{said(13, 70)}\n{said(14, 6)}"), (11, f" {said(13, 70)}\t{said(14, 6)} "), (12, None), (13, ""), (14, "and " * 60 + "or"),
    (15, f"{said(20, 4000)} {P} {said(21, 4000)}"), (16, f"{said(22, 60)} x {P} y {said(20, 4000)}"), (17, " ".join(P.split()[:30]) + " other " + " ".join(P.split()[30:])),
]


@pytest.mark.parametrize(("window", "gram"), [(50, 12), (50, 50), (50, 1), (20, 7)])
def test_passages_against_brute_force(spark, window, gram):
    df = spark.createDataFrame(PLANTED, "doc_id long, text string").repartition(4)
    rows = line_dedup.remove_repeats(df, min_words=window, window=window, gram=gram).collect()
    want = passages(PLANTED, window)
    assert {r.doc_id: r.text for r in rows} == want
    if window == 50:
        cut = {r.doc_id for r in rows if r.removed}
        assert cut == {2, 3, 4, 5, 6, 8, 10, 11, 14, 15, 16}
    texts = dict(PLANTED)
    for r in rows:
        for s in r.removed:
            span = texts[r.doc_id][s.start : s.end]
            assert span == texts[r.doc_id].split("\n")[s.unit] or span == span.strip()


def test_passages_of_the_test_table(spark, table):
    docs = [(r.doc_id, r.text) for r in table("documents").collect()]
    assert {r.doc_id: r.text for r in line_dedup.remove_repeats(table("documents")).collect()} == passages(docs, 50)


def test_very_large_groups(spark, monkeypatch):
    """A passage in a third of all documents and many whole copies, with joins that shuffle."""
    from shelfprice.plans import joins

    docs = [(i, f"{said(100 + i, 20)} {P} {said(900 + i, 20)}" if i % 3 == 0 else P + " copy" if i % 3 == 1 else said(2000 + i, 60)) for i in range(600)]
    monkeypatch.setattr(line_dedup, "attach_groups", lambda *a, **b: joins.attach_groups(*a, **b, max_broadcast_rows=0))
    got = {r.doc_id: r.text for r in line_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == passages(docs, 50)


def test_short_lines_stay_and_are_reported(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.remove_repeats(df).collect()} | {6: ""} == dict(DOCS) | {6: ""}
    found = sorted(tuple(r) for r in line_dedup.repeated_units(df).collect())
    assert found == [(1, 2, 34, 61), (2, 0, 0, 30), (3, 0, 0, 27), (4, 0, 0, 27), (7, 1, 5, 32), (8, 1, 1, 28)]


def test_a_repeated_row_goes(spark):
    df = spark.createDataFrame([(1, P), (1, P), (None, "x"), (None, said(3, 60)), (None, said(3, 60))], "doc_id long, text string")
    texts = sorted(r.text for r in line_dedup.remove_repeats(df).collect())
    assert texts == sorted(["", "", P, "x", said(3, 60)])


def test_bounds_that_do_not_fit(spark):
    with pytest.raises(ValueError):
        line_dedup.remove_repeats(spark.createDataFrame(DOCS, "doc_id long, text string"), min_words=5)
