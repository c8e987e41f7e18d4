import html
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from shelfprice.llm import html_text
from shelfprice.llm.html_text import extract_main_text, main_text

STORY = "<h1>Title &amp; more</h1><p>First paragraph, with words; and more of them.<p>Second <b>one</b>, that is longer. It goes on."


def in_page(body, more=""):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}{more}</body></html>"


WANTED = "Title & more\nFirst paragraph, with words; and more of them.\nSecond one, that is longer. It goes on."


@pytest.mark.parametrize(
    "around",
    [
        "<nav><ul><li><a href=/x>One</a><li><a href=/y>Two</a></ul></nav>",
        "<header><h1>Site, name.</h1></header>",
        "<footer>&copy; host &middot; All rights, reserved.</footer>",
        "<aside><p>An aside, which is quite long. It has sentences, too.</p></aside>",
        '<div id="cookie-notice">We use cookies. Accept them, please, or leave now.</div>',
        '<div class="ad">Buy this, now. It is good, cheap, and here.</div>',
        '<section class="comments"><article class="comment"><p>I disagree, strongly, with all of it.</p></article></section>',
        "<form><p>Your name, please. <input name=a><button>Send, now.</button></form>",
        "<script>var t='</p>, text. more, text.';</script><style>a, b. c</style><!-- a, b. <p>c, d.</p> -->",
        '<div role="dialog">Stay, please. Sign up, now.</div><p hidden>Not shown, at all.</p>',
        '<div class="x9"><ul><li><a href=1>Link text, one.</a></li><li><a href=2>Link text, two.</a></li></ul></div>',
        "<div class=z>More</div>",
    ],
)
def test_what_is_no_article_is_left_out(around):
    for article in (f"<article>{STORY}</article>", f"<main>{STORY}</main>", f'<div class="story">{STORY}</div>'):
        assert main_text(in_page(around + article)) == WANTED
        assert main_text(in_page(article + around)) == WANTED


def test_pages_whose_whole_body_has_a_telling_class():
    assert main_text(f'<body class="has-sidebar comments-open"><article>{STORY}</article></body>') == WANTED


def test_blocks_and_white_space():
    page = "<article><p>a&nbsp;b<br>c\n  d<em>e</em></p>text, behind.<ul><li>one<li>two</ul><table><tr><td>x<td>y</table><pre>p\n q</pre></article>"
    assert main_text(page) == "a b c de\ntext, behind.\none\ntwo\nx\ny\np q"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("   ", ""), ("<p>", ""), ("just text", "just text"), ("a < b", "a < b"), ("<p>a<!-- open", "a"),
        ("<script>never closed", ""), ("</p></div>x</b>", "x"), ('<p title="a > b">q</p>', "q"), ("<p title='x>y</p>", "y"),
        ("&lt;b&gt; &#233; &eacute; &bogus;", "<b> é é &bogus;"), ("<ARTICLE><P>Up</P></ARTICLE>", "Up"),
    ],
)
def test_broken_pages(page, text):
    assert main_text(page) == text


def test_long_and_deep_pages_take_linear_time():
    for page in ("<div>" * 20_000 + "x", "<p>w, </p>" * 50_000, "<b>" * 50_000 + "text", '<a title="' * 3000, "<" * 100_000):
        start = time.perf_counter()
        main_text(page)
        assert time.perf_counter() - start < 10


def test_the_test_table(spark, table):
    """Pages of the test table have one article of headings and paragraphs."""
    from html import unescape

    pages = {r.page_id: r for r in table("pages").collect()}
    got = extract_main_text(table("pages")).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.DOTALL)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]+>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_odd_rows(spark):
    data = [(1, "u", None), (1, "u", None), (None, None, "<p>a</p>"), (2, "v", "")]
    df = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("text", F.lit("z")).withColumn("n_chars", F.lit(9))
    rows = sorted((tuple(r) for r in extract_main_text(df).collect()), key=repr)
    assert rows == sorted([(1, "u", "", 0), (1, "u", "", 0), (None, None, "a", 1), (2, "v", "", 0)], key=repr)
    assert extract_main_text(df.limit(0)).count() == 0


PARTS = "<h1>Short</h1>" + "<p>A paragraph, of some length; it goes on, and on, for quite a while, as such things do.</p>" * 6
PARTS += "<ul><li>one<li>two</ul><table><tr><td>cell</table><p class=s>small</p>"


@pytest.mark.parametrize("page", ["<html><body>{}</body></html>", "{}", "<body><div>{}</div></body>", "<body><form id=form>{}<select><option>x</select></form></body>"])
def test_short_parts_of_an_article_without_container_stay(page):
    links = "<ul class=top><li><a href=1>Home</a></ul>"
    lines = main_text(page.format(links + PARTS)).split("\n")
    assert len(lines) == 11 and [x for x in lines if len(x) < 20] == ["Short", "one", "two", "cell", "small"]


def test_headings_between_running_text_of_one_element():
    text = "Words, and more words; they go on, and on, for quite a while, as such things do. " * 4
    assert main_text(f"<body><div>{text}<h2>Head</h2>{text}</div><div class=z>Foot</div>").split("\n") == [text.strip(), "Head", text.strip()]


def test_forms_to_fill_in_are_left_out():
    form = "<form><p>Your name, please.</p><p>Name: <input></p></form>"
    assert main_text(f"<body>{form}{PARTS}{form}</body>") == main_text(f"<body>{PARTS}</body>")
    assert main_text("<form>Search <input></form>") == ""


@pytest.mark.parametrize("depth", [200, 254, 255, 256, 257, 300])
def test_left_out_elements_at_any_depth(depth):
    deep = "<div>" * depth + f"{STORY}<nav><ul><li>Away, from. <div>here.</div> Go.</ul> Go.</nav><p>Last, and least. It ends.</p>" + "</div>" * depth
    assert main_text(f"<body>{deep}<nav>Go, there. Go.</nav></body>").split("\n")[-1] == "Last, and least. It ends."
    assert "Go" not in main_text(f"<body>{deep}</body>") and "Away" not in main_text(f"<body>{deep}</body>")


ARTICLE = "<h1>On the matter</h1><p>First sentence of it, with commas. Second one here.</p><p>More of the same text, again. And again.</p>"
TEXT = "On the matter\nFirst sentence of it, with commas. Second one here.\nMore of the same text, again. And again."


@pytest.mark.parametrize("name", ["social-science", "notice-board", "search-engine-history", "menu-reform", "login-guide", "header-files"])
def test_a_name_does_not_hide_the_article(name):
    for page in (f"<div class='{name}'>{ARTICLE}</div>", f"<div id='{name}'><div class='menu-x'>{ARTICLE}</div></div>", f"<form class='{name}'><div>{ARTICLE}</div></form>"):
        assert html_text.main_text(f"<html><body><nav><a href=x>menu</a></nav>{page}<footer>foot.</footer></body></html>") == TEXT


def test_named_parts_beside_an_article_go():
    for part in ("<div class=cookie-notice>We use them. Really. A lot. And a lot more of them here. " * 2, "<div class=comments>" + "<p>So true. Yes.</p>" * 40, "<ul class=related><li>Other text. Yes."):
        assert html_text.main_text(f"<body><div class=post>{ARTICLE}</div>{part}</body>") == TEXT
    junk = "<div class=ad>Buy this, now. Or that.</div><article><h1>no marks here</h1><p>junk junk junk</p></article>"
    assert html_text.main_text(f"<body>{junk}</body>") == "no marks here\njunk junk junk"


def test_depth_has_no_bound():
    """A page reads alike however deep it lies, and in time that does not grow with the square of the depth."""
    page = f"<nav>menu</nav><div class=a>{ARTICLE}</div><div class=menu><ul><li><a href=x>link</a></ul></div>"
    for depth in (1, 255, 300, 5000):
        assert html_text.main_text(f"<body>{'<div>' * depth}{page}{'</div>' * depth}<p class=foot><a>x</a></p></body>") == TEXT
    assert html_text.main_text("<div>word. " * 50_000).count("word.") > 0


def test_common_part_of_two_paths():
    paths = html_text.Paths()
    nodes = {(): 0}
    for i in range(400):
        base = random.Random(i).choice(sorted(nodes))
        label = random.Random(-i).choice(["div.a", "div.b", "p", "body"])
        nodes[(*base, label)] = paths.child(nodes[base], label)
    for i in range(2000):
        a, b = (random.Random(f"{i}{x}").choice(sorted(nodes)) for x in "ab")
        common = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        assert paths.common(nodes[a], nodes[b]) == nodes[a[:common]] and paths.depth[nodes[a]] == len(a)


def plain_reading(page):
    """Text of the planted pages by taking away what is told to be no article, tag by tag."""
    page = re.sub(r"(?s)<!--.*?-->|<(script|style|head|nav|footer|aside|form|noscript)\b.*?</\1>", "", page)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", page)).split())


def test_planted_pages_by_a_plain_reading(spark):
    parts = [f"<p>Paragraph {i} of it, which is long enough. It has &amp; and &#233;.</p>" for i in range(5)]
    pages = []
    for i, wrap in enumerate(["<article>{}</article>", "<main><div>{}</div></main>", "<div class=post>{}</div>", "{}", "<div id=x><section>{}</section></div>"]):
        body = wrap.format("<h2>A heading</h2>" + "".join(parts) + "<ul><li>one thing</li><li>another thing</li></ul>")
        pages.append((i, f"u{i}", f"<html><head><title>t</title></head><body><nav><ul><li><a>Home</a></li></ul></nav>{body}<aside>More. Of it.</aside><footer>&copy; x</footer></body></html>"))
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: " ".join(r.text.split()) for r in html_text.extract_main_text(df).collect()}
    assert got == {i: plain_reading(page) for i, _, page in pages}
