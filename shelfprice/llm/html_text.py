"""Main text of web pages by tag-path ratios.

A page is cut into blocks: runs of text between block-level tags, known by the path of such tags (with
their classes) from the root. Per path the length of the text, its punctuation and its share inside links are added up over all
blocks of the page and divided by their number. These ratios are fused into one score, which is smoothed
along the page, more strongly the more of their paths two neighbours share, and averaged over each path
again. Paths with a fair part of the best score are content, and so are the shorter parts of running text
(headings, lists, tables) in the same containers, if they are not mostly links; their blocks are the text.
The body is such a container if paragraphs on content paths lie directly in it.

Elements that are never article text (scripts, styles, menus, headers, footers, sidebars, notices,
adverts and reader comments) are left out before the ratios are formed if their tag, role or attributes say so, or a class or id that
speaks of comments. Forms, and elements of which only some other word of a class or id says so, are in doubt: a form with more than
half of the page's sentences is no form to fill in but holds the page, and an element with nearly all of its text is no menu or notice; these stay,
the others go. Paths inside ``article`` or ``main`` start
with a higher score.

Paths are nodes of a tree, and common parts of two paths are found by jumps towards the root, so that deep nesting
costs no more than its logarithm per block.

Defined results: NULL, empty and text-less pages give ''; broken markup (unclosed or stray tags, comments
without an end) is read as far as it goes; character references are decoded; white space inside a block,
``<br>`` included, becomes one space; repeated rows stay; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
import sys
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# --- fixed sets of names -------------------------------------------------------------------------

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead tr ul".split()
)
_LEFT_OUT = frozenset(
    "head script style noscript template textarea title iframe object svg canvas nav footer aside form button select "
    "dialog menu search audio video map math".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promos promotion banner sidebar sidebars "
    "nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead topbar cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay comment comments reply replies discussion disqus related recommended "
    "recommendations share sharing social newsletter subscribe subscription signup login search pagination pager widget "
    "widgets toolbar skip hidden form".split()
)
_COMMENTS = frozenset("comment comments reply replies discussion disqus".split())
_HEADERS = frozenset({"header", "headers"})
_WHOLE = frozenset({"html", "body", "main", "article"})
# Blocks that are parts of running text.
_IN_TEXT = frozenset(
    "p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre figure figcaption "
    "details summary address center".split()
)
# An open element of the first kind ends where one of the second kind begins.
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
}
_LISTS = frozenset({"ul", "ol", "dl", "table", "select", "article", "section", "div", "body", "main"})

_TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)"
    r"|(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)>"
    r"|[!?/][^>]*>)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.IGNORECASE)
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")

_SENTENCE = re.compile(r"[.!?…。！？]")

# --- scores --------------------------------------------------------------------------------------

# Parts of the page's sentences, or text, from which on a form, or an element known by name only, holds the page.
FORM_HOLDS = 0.5
NAMED_HOLDS = 0.9
ARTICLE_PRIOR = 5.0
STRANGERS = 0.03
REACH = 3
SHARE_OF_BEST = 0.12


def _attributes(rest: str) -> dict[str, str]:
    if "=" not in rest and "hidden" not in rest:
        return {}
    return {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(rest)}


def _verdict(tag: str, rest: str, in_article: bool) -> str:
    """Whether an element is ``out``, whatever it holds, in ``doubt`` or ``in``."""
    if (tag in _LEFT_OUT and tag != "form") or (tag == "header" and not in_article):
        return "out"
    doubt = "doubt" if tag == "form" else "in"
    attributes = _attributes(rest)
    if not attributes or (tag in _WHOLE and not (tag == "article" and "comment" in attributes.get("class", ""))):
        return doubt
    own = {"form"} if tag == "form" else set()
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or (attributes.get("role") in _ROLES - own):
        return "out"
    if "display:none" in attributes.get("style", "").replace(" ", ""):
        return "out"
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        parts = set(re.split(r"[^a-z0-9]+", name))
        if parts & {"has", "with", "no", "without", "is"}:
            continue
        if parts & _COMMENTS:
            return "out"
        if parts & (_NAMES - own) or (parts & _HEADERS and not in_article):
            doubt = "doubt"
    return doubt


class Paths:
    """All paths of block-level labels of a page as a tree; node 0 is the empty path."""

    def __init__(self) -> None:
        self.parent, self.jump, self.depth = [0], [0], [0]
        self.tags = [""]
        self.in_article, self.only_page = [False], [True]
        self._known: dict[tuple[int, str], int] = {}

    def child(self, node: int, label: str) -> int:
        found = self._known.get((node, label))
        if found is not None:
            return found
        number = self._known[node, label] = len(self.parent)
        tag = label.partition(".")[0]
        near = self.jump[node]
        # Jumps of equal length are joined to one of twice that length.
        twice = self.depth[node] - self.depth[near] == self.depth[near] - self.depth[self.jump[near]]
        self.parent.append(node)
        self.jump.append(self.jump[near] if twice else node)
        self.depth.append(self.depth[node] + 1)
        self.tags.append(tag)
        self.in_article.append(self.in_article[node] or tag in ("article", "main"))
        self.only_page.append(self.only_page[node] and tag in ("html", "body"))
        return number

    def common(self, a: int, b: int) -> int:
        """The deepest node that both paths pass."""
        if self.depth[a] < self.depth[b]:
            a, b = b, a
        while self.depth[a] > self.depth[b]:
            a = self.jump[a] if self.depth[self.jump[a]] >= self.depth[b] else self.parent[a]
        while a != b:
            if self.jump[a] != self.jump[b]:
                a, b = self.jump[a], self.jump[b]
            else:
                a, b = self.parent[a], self.parent[b]
        return a

    def alike(self, a: int, b: int) -> float:
        """How much of their paths two blocks share; hardly anything if only the whole page."""
        common = self.common(a, b)
        if self.only_page[common]:
            return STRANGERS
        return (self.depth[common] / max(self.depth[a], self.depth[b])) ** 2


class _Element:
    __slots__ = ("doubt", "out", "path", "tag")

    def __init__(self, tag: str, out: bool, doubt: int, path: int) -> None:
        self.tag, self.out, self.doubt, self.path = tag, out, doubt, path


class Page:
    """Blocks of a page: node of the path, text, and how much of the text is inside links."""

    def __init__(self) -> None:
        self.paths = Paths()
        self.open: list[_Element] = []
        self.counts: Counter[str] = Counter()  # open elements by tag
        self.blocks: list[tuple[int, str, float]] = []
        self.doubts: list[int] = []  # innermost element in doubt around the same block, 0 for none
        self.outer_doubt = [0]  # of each element in doubt, the one around it
        self.must_hold = [0.0]  # and the part of the page that it must hold to stay
        self.parts: list[str] = []
        self.linked = 0

    def text(self, raw: str) -> None:
        if not raw or (self.open and self.open[-1].out):
            return
        self.parts.append(raw)
        if self.counts["a"] and any(e.tag == "a" for e in self.open[-4:]):
            self.linked += len(raw)

    def flush(self) -> None:
        if self.parts:
            raw = "".join(self.parts)
            text = " ".join(html.unescape(raw).split())
            if text:
                inner = self.open[-1] if self.open else None
                self.blocks.append((inner.path if inner else 0, text, min(1.0, self.linked / len(raw))))
                self.doubts.append(inner.doubt if inner else 0)
        self.parts, self.linked = [], 0

    def start(self, tag: str, rest: str) -> None:
        block = tag in _BLOCK
        if block:
            self.flush()
            self._end_implied(tag)
        elif tag == "br":
            self.parts.append(" ")
        if tag in _VOID:
            return
        around = self.open[-1] if self.open else _Element("", False, 0, 0)
        verdict = "out" if around.out else _verdict(tag, rest, bool(self.counts["article"] or self.counts["main"]))
        doubt, path = around.doubt, around.path
        if verdict == "doubt":
            self.outer_doubt.append(doubt)
            self.must_hold.append(FORM_HOLDS if tag == "form" else NAMED_HOLDS)
            doubt = len(self.outer_doubt) - 1
        if block and verdict != "out":
            name = _attributes(rest).get("class", "")
            path = self.paths.child(path, f"{tag}.{name}" if name else tag)
        self.open.append(_Element(tag, verdict == "out", doubt, path))
        self.counts[tag] += 1

    def _close(self, at: int) -> None:
        self.counts.subtract(e.tag for e in self.open[at:])
        del self.open[at:]

    def _end_implied(self, tag: str) -> None:
        if tag in _ENDS and any(self.counts[t] for t in _ENDS[tag]):
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i].tag in _ENDS[tag]:
                    self._close(i)
                    return
                if self.open[i].tag in _LISTS:
                    break
        # A block ends an open paragraph.
        if self.counts["p"]:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i].tag == "p":
                    self._close(i)
                    return
                if self.open[i].tag in _BLOCK:
                    return

    def end(self, tag: str) -> None:
        block = tag in _BLOCK
        if block:
            self.flush()
        if not self.counts[tag]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag == tag:
                self._close(i)
                return
            if not block and self.open[i].tag in _BLOCK:
                return

    def settle(self) -> None:
        """Drop the blocks in doubtful elements that do not hold enough of the page."""
        if not any(self.doubts):
            return
        # Of each element in doubt: its text outside of links, of sentences for a form and of all kinds for the others.
        sentences, plain = ([0.0] * len(self.outer_doubt) for _ in range(2))
        for doubt, (_, text, linked) in zip(self.doubts, self.blocks, strict=True):
            plain[doubt] += len(text) * (1 - linked)
            sentences[doubt] += len(text) * (1 - linked) if _SENTENCE.search(text) else 0
        totals = {FORM_HOLDS: sum(sentences), NAMED_HOLDS: sum(plain)}
        # Inner elements have larger numbers than those around them.
        for running in (sentences, plain):
            for number in range(len(running) - 1, 0, -1):
                running[self.outer_doubt[number]] += running[number]
        kept = [True]
        for number in range(1, len(plain)):
            part = self.must_hold[number]
            held = sentences if part == FORM_HOLDS else plain
            kept.append(kept[self.outer_doubt[number]] and held[number] > part * totals[part])
        self.blocks = [b for doubt, b in zip(self.doubts, self.blocks, strict=True) if kept[doubt]]


def read_page(page: str) -> Page:
    """The blocks that may be article text, in page order, and their paths."""
    state, at = Page(), 0
    while m := _TAG.search(page, at):
        state.text(page[at : m.start()])
        at = m.end()
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            state.end(tag)
            continue
        state.start(tag, m["rest"])
        if tag in _RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
            at = close.start() if close else len(page)
    state.text(page[at:])
    state.flush()
    state.settle()
    return state


def _belonging(paths: Paths, containers: set[int]) -> list[bool]:
    """Per node whether it lies in a container of content, below it only in parts of running text."""
    out = []
    for node, parent in enumerate(paths.parent):
        passes = node and (paths.tags[node] in _IN_TEXT or paths.in_article[node])
        out.append(node in containers or bool(passes and out[parent]))
    return out


def content(page: Page) -> list[str]:
    """Texts of the blocks on content paths."""
    paths, blocks = page.paths, page.blocks
    sums: dict[int, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0, 0.0])
    for path, text, linked in blocks:
        s = sums[path]
        s[0] += 1
        s[1] += len(text)
        s[2] += len(_PUNCTUATION.findall(text))
        s[3] += linked * len(text)
    raw = {}
    for path, (n, length, marks, linked) in sums.items():
        prior = ARTICLE_PRIOR if paths.in_article[path] else 1.0
        raw[path] = prior * (length / n) * (1 + marks / n) * (1 - linked / length) ** 2
    totals: dict[int, list[float]] = defaultdict(lambda: [0.0, 0.0])
    for i, (path, _, _) in enumerate(blocks):
        weight = value = 0.0
        for j in range(max(0, i - REACH), min(len(blocks), i + REACH + 1)):
            other = blocks[j][0]
            w = (1.0 if i == j else 0.5 ** abs(i - j)) * (1.0 if other == path else paths.alike(path, other))
            weight += w
            value += w * raw[other]
        totals[path][0] += value / weight
        totals[path][1] += 1
    smooth = {path: value / n for path, (value, n) in totals.items()}
    best = max(smooth.values(), default=0.0)
    chosen = {path for path, score in smooth.items() if score >= SHARE_OF_BEST * best}
    # What holds content paths holds the shorter parts of the same text.
    containers = set()
    for path in chosen:
        in_text = bool(path) and paths.tags[path] in _IN_TEXT
        if path and (in_text or not paths.only_page[paths.parent[path]]):
            containers.add(paths.parent[path])
        if not in_text:
            containers.add(path)  # text that lies in it directly
    belongs = _belonging(paths, containers)
    for path, (_, length, _, linked) in sums.items():
        if path not in chosen and 2 * linked < length and belongs[path]:
            chosen.add(path)
    return [text for path, text, _ in blocks if path in chosen]


def main_text(page: str | None) -> str:
    return "\n".join(content(read_page(page))) if page else ""


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column("html")]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
        columns.append(pa.array(map(len, texts), pa.int64()))
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per page; pages are read where they lie, nothing is shuffled."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"
    return pages.select("page_id", "url", "html").mapInArrow(_reader, schema)
