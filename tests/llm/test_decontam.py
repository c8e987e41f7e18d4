import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfprice.llm import decontam


def plain(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[^\w\x20\x09-\x0D]+|_", "", (text or "").lower()))


def brute(docs, items):
    """Best similarity over all windows of every document and item."""
    found = {}
    for doc_id, text in docs:
        words = plain(text)
        for item_id, item in items:
            target = plain(item)
            width = min(5, len(target))
            if not width or len(words) < width:
                continue
            bag = lambda w: Counter(tuple(w[i : i + width]) for i in range(len(w) - width + 1))  # noqa: E731, B023
            want, best = bag(target), 0
            for s in range(max(1, len(words) - len(target) + 1)):
                have = bag(words[s : s + len(target)])
                common = sum((have & want).values())
                best = max(best, common / (sum(have.values()) + sum(want.values()) - common))
            if best >= 0.8:
                found[doc_id, item_id] = max(best, found.get((doc_id, item_id), 0))
    return found


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def got(docs, items):
    rows = decontam.contaminated(docs, items).collect()
    assert len(rows) == len({(r.doc_id, r.item_id) for r in rows})
    return {(r.doc_id, r.item_id): r.similarity for r in rows}


ITEM = " ".join(f"word{i}" for i in range(60))
REPEATING = "the cat sat on the mat and " * 6
DOCS = [
    (1, f"before {ITEM} after"),
    (2, ITEM.upper().replace(" ", ", ") + "!"),
    (3, ITEM.replace("word30 ", "word30 new ")),  # one word more in the middle
    (4, ITEM.replace("word30", "other").replace("word10", "other").replace("word50", "other")),  # too different
    (5, " ".join(ITEM.split()[3:])),  # shorter than the item
    (6, " ".join(ITEM.split()[30:] + ITEM.split()[:30])),  # halves changed over
    (7, None), (8, ""), (9, "word1 word2"), (10, "- | *"), (11, f"x {REPEATING} y"), (12, REPEATING), (13, "the cat sat on the mat and"),
    (14, "pad " * 3000 + ITEM), (15, "a short one here"), (16, f"{ITEM} {ITEM}"), (17, "nothing to see"),
]
ITEMS = [(1, ITEM), (2, REPEATING), (3, None), (4, " "), (5, "short one"), (6, ITEM)]


@pytest.mark.parametrize("small", [True, False])
def test_against_all_windows(spark, monkeypatch, small):
    monkeypatch.setattr(decontam, "is_small", lambda *_: small)
    docs, items = frames(spark, DOCS, ITEMS)
    want = brute(DOCS, ITEMS)
    assert {(1, 1), (2, 1), (3, 1), (5, 1), (6, 1), (14, 1), (16, 6), (12, 2), (15, 5)} <= set(want) and (4, 1) not in want
    assert got(docs, items) == pytest.approx(want)


def test_the_test_table(spark, table):
    docs, items = table("documents"), table("benchmark")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert want and got(docs, items) == pytest.approx(want)


def test_long_items_use_wide_lanes(spark):
    hashes = F.array(*[F.lit(x).cast("long") for x in (-1, 5, 2**62, 7, -(2**63))])
    a, b = spark.range(1).select(decontam.simhash(hashes, 16), decontam.simhash(hashes, 32)).first()
    assert a == b == 5


def test_blocks_cover_all_bits_and_guarantee_the_radius():
    for radius in (3, 15, 19, 31):
        blocks = decontam._blocks(radius)
        assert len(blocks) == radius + 1 and sum(n for _, n in blocks) == 64
        assert [low for low, _ in blocks] == [sum(n for _, n in blocks[:i]) for i in range(len(blocks))]


def test_repeated_rows_extra_columns_and_empty_tables(spark):
    docs, items = frames(spark, [(1, ITEM), (1, ITEM), (1, "clean"), (None, ITEM), (2, "clean text"), (None, None)], [(1, ITEM), (1, ITEM)])
    docs = docs.selectExpr("*", "1 AS item", "2 AS grams", "3 AS start", "'q' AS n", "0 AS dirty_id", "1 AS id")
    pairs = decontam.contaminated(docs, items.withColumn("shingles", F.lit(1))).select("doc_id", "item_id").distinct().collect()
    assert {tuple(p) for p in pairs} == {(1, 1), (None, 1)}
    clean = decontam.keep_clean(docs, items)
    assert clean.columns == docs.columns and [r.text for r in clean.collect()] == ["clean text"]
    assert decontam.keep_clean(docs, items.limit(0)).count() == 6
    assert decontam.contaminated(docs.limit(0), items).count() == 0


def test_clean_texts_stay_beside_others_of_their_id(spark):
    docs, items = frames(spark, [(1, ITEM), (1, "clean"), (None, ITEM), (None, "clean too"), (None, None), (2, "clean")], [(1, ITEM)])
    kept = decontam.keep_clean(docs, items, by_text=True).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == [(1, "clean"), (2, "clean"), (None, "clean too"), (None, None)]
