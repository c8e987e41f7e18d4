import random
import datetime
import time

import pytest

from checks import queries
from shelfprice.functions import markup
from shelfprice.functions.markup import Matches, read_page, selector_chains
from shelfprice.operators import extract
from shelfprice.schema import PAGE_SCHEMA

NOW = datetime.datetime(2024, 3, 10, 2, 30, 15, 999999)  # inside a daylight-saving gap


def matches(html):
    return Matches(read_page(html))


def tiers(*groups):
    return [selector_chains(group) for group in groups]


def texts(html, group):
    return [e.text() for e in matches(html).all(tiers(group))]


@pytest.mark.parametrize(
    ("html", "group", "found"),
    [
        ("<p class='a b'>1</p><p class=b>2</p>", ".a.b", ["1"]),
        ("<p class='xay'>1</p>", "[class*='a']", ["1"]),
        ("<p id=k>1</p><b id=k>2</b>", "b[id='k']", ["2"]),
        ("<p data-x>1</p><p>2</p>", "[data-x]", ["1"]),
        ("<div><p><s>1</s></p></div><s>2</s>", "div s", ["1"]),
        ("<div class=q></div><n>1</n><n>2</n>", "div.q+n", ["1"]),
        ("<div><span>1</span><span>2</span></div>", "div span:first-child", ["1"]),
        ("<div>t<span>1</span></div>", "span:first-child", ["1"]),
        ("<i>1</i><b>2</b>", "b, i", ["1", "2"]),
        ("<ul><li>1<li>2</ul><li>3", "li", ["1", "2", "3"]),
        ("<a>1<a>2</a>", "a", ["1", "2"]),
        ("<p>1<div>2</div>", "p", ["1"]),
        ("<div><br>1<img src=x>2</div></b>", "div", ["12"]),
        ("<div> a <b> b</b> c<script>x</script><!-- y --></div>", "div", ["abc"]),
        ("<div>1 < 2 <!-- y --> 3 &amp; 4</div>", "div", ["1 < 23 & 4"]),
        ("<div>&lt;a&gt; &amp;&nbsp;</div>", "div", ["<a> &"]),
        ("<div><p>open", "div p", ["open"]),
        ("", "p", []),
    ],
)
def test_selectors(html, group, found):
    assert texts(html, group) == found


def test_first_tier_with_a_match_wins():
    page = matches("<b>1</b><i>2</i><i>3</i>")
    assert [e.text() for e in page.all(tiers("u", "i", "b"))] == ["2", "3"]
    assert page.first(tiers("u", "i", "b")).text() == "2"
    assert page.first(tiers("u")) is None


def test_first_inside_an_element():
    page = matches("<div class=c><p><b>1</b></p></div><b>2</b><div class=c><b>3</b><b>4</b></div><div class=c></div>")
    inside = [page.first(tiers("b"), card) for card in page.all(tiers(".c"))]
    assert [e.text() if e else None for e in inside] == ["1", "3", None]
    assert [e.text() for e in page.all(tiers(".c p b, .c+b"))] == ["1", "2"]


def test_deeply_nested_pages_take_linear_time():
    times, card, field = [], tiers("div .c"), tiers("div .c i")
    for depth in (5_000, 20_000):
        start = time.perf_counter()
        page = matches("<div class='c'><i>" * depth + "</b>" * depth)
        assert sum(page.first(field, found) is not None for found in page.all(card)) == depth - 1
        times.append(time.perf_counter() - start)
    assert times[1] < 12 * times[0]


def pages(spark, *rows):
    full = [(i, layout, f"P{layout}", NOW, "https://h.example/list?x", html) for i, (layout, html) in enumerate(rows)]
    return spark.createDataFrame(full, PAGE_SCHEMA)


def test_sale_and_regular_prices(spark):
    def card(inner):
        return f"<a data-test-id='productLink' href='/p'><b data-test-id='productTitle'>N</b>{inner}</a>"

    regular, sale = "<i data-test-id='originalPrice'>RM{}</i>", "<i data-test-id='specialPrice'>{}</i>"
    inners = [regular.format(50) + sale.format("RM30 - RM40"), regular.format(50), sale.format("soon"), ""]
    html = "".join(map(card, inners))
    rows = extract.extract_listings(pages(spark, ("Z", html))).orderBy("order_key").collect()
    prices = [(r["current_price"], r["original_price"]) for r in rows]
    assert prices == [(30.0, 50.0), (50.0, None), (None, None), (None, None)]
    assert {r["scraped_at"] for r in rows} == {"2024-03-10T02:30:15"}
    assert {(r["platform"], r["category"], r["product_url"]) for r in rows} == {("PZ", "fashion", "https://h.example/p")}


def test_link_fallbacks_and_missing_links(spark):
    s = "<div data-sqe='item'>{}<div data-sqe='name'>n</div></div>"
    html = s.format("<a href='//q'></a><a href='/x-i.5'></a>") + s.format("<a href=z>t</a>") + s.format("")
    rows = extract.extract_listings(pages(spark, ("S", html))).orderBy("order_key").collect()
    assert [r["product_url"] for r in rows] == [
        "https://h.example/x-i.5",
        "https://h.example/z",
        "https://h.example/",
    ]
    one = "<div class=Bm3ON><div class=RfADt><a>n</a></div></div>"
    assert extract.extract_listings(pages(spark, ("L", one))).first()["product_url"] == ""


def test_empty_unknown_and_unreadable_pages_do_not_stop_the_run(spark, monkeypatch):
    card = "<a data-test-id='productLink' href='/p'><b data-test-id='productTitle'>N</b></a>"
    df = pages(spark, ("Z", None), ("Z", "<p>no cards"), ("?", "x"), ("Z", card))
    cards = extract.card_texts(df)
    assert extract.listings_of_cards(cards).count() == 1
    summary = {r["layout"]: r for r in extract.extraction_summary(cards).collect()}
    assert (summary["Z"]["empty_pages"], summary["Z"]["listings"]) == (2, 1)
    assert summary["?"]["unreadable_pages"] == 1


def test_a_broken_card_is_isolated(monkeypatch):
    def fails_on_second(page, card, rules, seen=[]):
        seen.append(card)
        if len(seen) == 2:
            raise ValueError("odd card")
        return {"name": "n"}

    monkeypatch.setattr(extract, "_card_texts", fails_on_second)
    found = extract._page_cards("<b>1</b><b>2</b><b>3</b>", {"cards": tiers("b")})
    assert [c.get("error") for c in found] == [None, "card: odd card", None]


def test_whole_page_is_read(spark):
    filler = "<p>" + "x" * 3_000_000 + "</p>"
    card = "<a data-test-id='productLink' href='/p'><b data-test-id='productTitle'>N</b></a>"
    assert extract.extract_listings(pages(spark, ("Z", filler + card))).count() == 1


@pytest.mark.parametrize("bad", ["#k", '[a="b"]', "div > a", "[a^='b']", "p:nth-child(2)", "p:not(.a)", "*", "", "a,", "a +", "+ a", "a. b"])
def test_selectors_that_are_not_understood_are_refused(bad):
    with pytest.raises(ValueError, match="selector"):
        selector_chains(bad)


def test_layouts_with_such_selectors_fail_before_any_job(spark):
    with pytest.raises(ValueError, match="selector"):
        extract.card_texts(spark.createDataFrame([], PAGE_SCHEMA), {"x": {"card": ["#k"]}})


def test_one_reading_gives_listings_errors_and_counts(spark, monkeypatch):
    """Nothing is dropped without a trace: unreadable cards and pages stand beside the listings of the same run."""
    card = "<a data-test-id='productLink' href='/{0}'><b data-test-id='productTitle'>{0}</b></a>"
    html = "".join(card.format(x) for x in "abc")
    texts = extract._card_texts

    def fails_on_b(page, element, rules):
        if element.attrs.get("href") == "/b":
            raise ValueError("odd card")
        return texts(page, element, rules)

    monkeypatch.setattr(extract, "_card_texts", fails_on_b)
    found = extract.extract(pages(spark, ("Z", html), ("?", html), ("Z", "<p>")))
    assert sorted(r["product_name"] for r in found.listings.collect()) == ["a", "c"]
    assert sorted((r["layout"], r["card_no"], r["error"]) for r in found.errors.collect()) == [("?", None, "page: unknown layout"), ("Z", 1, "card: odd card")]
    counts = {r["layout"]: (r["cards"], r["listings"], r["unreadable_cards"], r["unreadable_pages"], r["empty_pages"]) for r in found.summary.collect()}
    assert counts == {"Z": (3, 2, 1, 0, 1), "?": (0, 0, 0, 1, 0)}
    # The pages are gone from all three plans: they were read once.
    for df in (found.listings, found.errors, found.summary):
        assert "MapInArrow" not in df._jdf.queryExecution().executedPlan().toString()


def test_the_query_of_errors_reads_all_captured_pages(spark, monkeypatch):
    card = "<a data-test-id='productLink' href='/p'><b data-test-id='productTitle'>N</b></a>"
    captured = pages(spark, ("Q", "x"), ("L", "<p>"), ("S", "<p>"), ("Z", card), ("?", "x"), (None, "x"))
    monkeypatch.setattr(queries.pages, "captured_pages", lambda spark, sf_dir: captured)
    read, whole = [], extract.extract

    def noted(given):
        read.append(sorted(row["page_id"] for row in given.collect()))
        return whole(given)

    monkeypatch.setattr(queries.extract, "extract", noted)
    errors = queries.QUERIES["extraction_errors"](spark, "").collect()
    assert read == [[0, 1, 2, 3, 4, 5]]
    assert sorted((r["page_id"], r["error"]) for r in errors) == [(i, "page: unknown layout") for i in (0, 4, 5)]


def test_selectors_against_a_walk_over_all_elements():
    """Chains of all kinds over random trees, looked up in the lists and tested one by one."""
    draw = random.Random(3)

    def tree(depth):
        return "".join(f"<{t} class='{draw.choice('xyz')} {draw.choice('uv')}' {draw.choice(['k=1', 'm', ''])}>{tree(depth - 1) if depth else ''}</{t}>" for t in draw.choices(["div", "b", "i"], k=draw.randrange(1, 4)))

    def slow(element, chain):
        (relation, tests), rest = chain[0], chain[1:]
        if not markup._fits_one(element, tests):
            return False
        if not rest:
            return True
        if relation == "+":
            return element.before is not None and slow(element.before, rest)
        above = element.parent
        while above is not None and above.tag:
            if slow(above, rest):
                return True
            above = above.parent
        return False

    selectors = [".x", "b.y", "div b", ".x .y", "div.x + b", "[k]", "i[k='1'] .u", "div :first-child", ":first-child", "div div div", ".x + .y .z", "b + b, i .v", "q", ".x.u b"]
    for _ in range(40):
        root = markup.read_page(tree(4))
        page = markup.Matches(root)
        for selector in selectors:
            chains = markup.selector_chains(selector)
            assert page._numbers(chains) == [n for n, e in enumerate(page.elements) if any(slow(e, c) for c in chains)]


def shape(element):
    return [
        c if isinstance(c, str) else (c.tag, c.attrs, list(c.classes), c.before and c.before.tag, shape(c)) for c in element.children
    ]


PLAIN = [
    "<!DOCTYPE html><p class='a  b' id=x>one &amp; two<br/>three<div CLASS=\"c>d\" class=e>four<!-- five - six -->seven</DIV >",
    "<script>if(1<2)'</a>';</script><style>.x{}</style><title>a &lt; b</title><ul><li>1<li hidden>2</ul><a href='/p?a=1&amp;b=2'>",
]
ODD = ["a < b<p", "<a href=x/>t", "<script>x", "<script><!-- </script> --></script>", "<p a='1'b=2>", "<!x><?y>z", "<textarea><b></textarea>"]


def test_plain_pages_are_read_without_the_standard_parser(monkeypatch):
    expected = [shape(markup.read_any_page(html)) for html in PLAIN]
    monkeypatch.setattr(markup, "_Builder", None)
    assert [shape(markup.read_page(html)) for html in PLAIN] == expected


def test_both_readers_give_one_tree():
    rng, known = random.Random(3), {}
    for html in PLAIN + ODD:
        assert shape(markup.read_page(html, known)) == shape(markup.read_any_page(html))
    for _ in range(2000):
        html = "".join(rng.choice(PLAIN + ODD)[(at := rng.randrange(40)) : at + rng.randrange(80)] for _ in range(3))
        assert shape(markup.read_page(html, known)) == shape(markup.read_any_page(html)), html


MIXED = [
    "<p>a<div><b>x<i>y</b>z</i><title>q &lt; r</title> s</p> t</div>",
    "<STYLE>.x{}</STYLE ><script>if(a<b)'</b>'</script>u<!-- a > <b> - c -->v<br/>w<i title='a > b' hidden>x</i>",
    "a</b> b<!doctype html>c<template>t<b>u</b></template><ul><li>1<li>2<p>3<li>4</ul>5",
]


def test_plain_pages_are_cut_without_an_expression_for_whole_pages(monkeypatch):
    expected = [shape(markup.read_any_page(html)) for html in PLAIN + MIXED]
    texts_of = [markup.read_any_page(html).text() for html in PLAIN + MIXED]
    monkeypatch.setattr(markup, "_Builder", None)
    inside = "<i title='a < b'>t</i>"  # this one needs it
    assert markup.read_page(inside).children[0].attrs == {"title": "a < b"}
    monkeypatch.setattr(markup, "_PIECE", None)
    known = {}
    for _ in range(2):  # with tags that are new, and with known ones
        assert [shape(markup.read_page(html, known)) for html in PLAIN + MIXED] == expected
        assert [markup.read_page(html, known).text() for html in PLAIN + MIXED] == texts_of


def test_tags_are_looked_at_once_whatever_the_number_of_pages_and_groups(monkeypatch):
    looked, look_at = [], markup.Plan.look_at
    monkeypatch.setattr(markup.Plan, "look_at", lambda plan, tag: (looked.append(tag.name), look_at(plan, tag)))
    rules = extract._compiled({"Z": extract.LAYOUTS["Z"]})["Z"]
    card = "<a data-test-id='productLink' href='/p'><b data-test-id='productTitle'>{}</b></a>"
    known, plan = {}, extract._plan(rules)
    found = [extract._page_cards(card.format(n) * 3, rules, known, plan) for n in range(20)]
    assert [[c["name"] for c in cards] for cards in found] == [[str(n)] * 3 for n in range(20)]
    assert looked == ["a", "b"]


def test_selectors_of_one_plan_give_what_each_gives_alone():
    groups = [".x", "b.y, i", "div b", ".x .y", "div.x + b, .v", "div div b", ":first-child", "div span:first-child", "b + b i"]
    compiled = [markup.selector_chains(group) for group in groups]
    plan, draw = markup.Plan(compiled), random.Random(5)
    for _ in range(200):
        tags = [f"<{draw.choice(['div', 'b', 'i', 'span', 'p', '/div', '/b', '/i', 'br'])}" for _ in range(30)]
        html = "".join(t + (">" if t[1] == "/" else f" class='{draw.choice('xyz')} {draw.choice('uv')}'>") for t in tags)
        root = markup.read_page(html)
        together = markup.Matches(root, plan)
        for group in compiled:
            assert together._numbers(group) == markup.Matches(root)._numbers(group)


def test_every_price_is_parsed_once(spark):
    """Code that parses the prices of all layouts apart is too long to be compiled well."""
    html = "<div data-sqe='item'><div data-sqe='name'>n</div><span class=_341bF9>RM1,200.50 - RM9</span><s>RM{}</s></div>"
    df = pages(spark, ("S", html.format("3,000")), ("S", html.format("-")))
    listings = extract.listings_of_cards(extract.card_texts(df))
    assert [(r["current_price"], r["original_price"]) for r in listings.orderBy("order_key").collect()] == [(1200.5, 3000.0), (1200.5, None)]
    plan = listings.select("current_price", "original_price")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[^0-9.]") <= 4  # each parse names its pattern twice
