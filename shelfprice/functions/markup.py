"""Small page reader used inside extraction tasks: elements, selectors, text.

Covers what card rules need: tag, class, attribute (present, equal, contains), first child, the
descendant and next-sibling relations, and groups of those.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from html import unescape
from html.parser import HTMLParser

_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_NO_TEXT = {"script", "style", "template"}
# Start tags that end a still open element of the listed kinds.
_ENDS = {
    "a": {"a"},
    "li": {"li", "p"},
    "p": {"p"},
    "div": {"p"},
    "ul": {"p"},
    "option": {"option"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
}
_SCOPE = {"ul", "ol", "table", "div", "section", "body", "html"}

_SIMPLE = re.compile(
    r"""(?P<tag>[a-zA-Z][\w-]*)
      | \.(?P<cls>[\w-]+)
      | \[(?P<attr>[\w-]+)(?:(?P<op>\*?=)'(?P<val>[^']*)')?\]
      | (?P<first>:first-child)""",
    re.VERBOSE,
)
_WHOLE = re.compile(r"(?=.)(?:[a-zA-Z][\w-]*)?(?:\.[\w-]+|\[[\w-]+(?:\*?='[^']*')?\]|:first-child)*")


# Markup that leaves nothing to interpret. A page that is made of such pieces only, back to back, is cut at its "<" or, where
# these stand inside of tags, by one expression; any other page is read by the standard parser, which gives the same tree.
_NAME = r"[a-zA-Z][a-zA-Z0-9_:-]*"
_ATTR = rf"""[ \t\r\n]+({_NAME})(?:=(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`/&]+)(?=[ \t\r\n>]|\Z)))?"""
_ATTRS = "(?:" + _ATTR.replace("(" + _NAME, "(?:" + _NAME).replace("([^", "(?:[^") + ")*"
_START = rf"{_ATTRS}[ \t\r\n]*/?>"
# Scripts and styles come with their text, which must hold nothing that could end or hide it.
_PLAIN_RAW = r"[^<]*(?:<(?!!|/\s*(?i:script|style))[^<]*)*"
_COMMENT = r"!--(?!-?>)[^-]*(?:-[^-]+)*-->"
_PIECE = re.compile(
    r"[^<]+"
    rf"|<(?i:script){_ATTRS}[ \t\r\n]*>{_PLAIN_RAW}</(?i:script)[ \t\r\n]*>"
    rf"|<(?i:style){_ATTRS}[ \t\r\n]*>{_PLAIN_RAW}</(?i:style)[ \t\r\n]*>"
    # Parsers differ over what these hold, unless it is text.
    rf"|<(?i:title|textarea){_ATTRS}[ \t\r\n]*>(?=[^<]*</(?i:title|textarea)[ \t\r\n]*>)"
    rf"|<(?!(?i:script|style|title|textarea|xmp|iframe|noembed|noframes|noscript|plaintext|svg|math)[\s/>]){_NAME}{_START}"
    rf"|</{_NAME}[ \t\r\n]*>"
    rf"|<{_COMMENT}"
    r"|<!(?i:doctype)[ \t\r\n][^<>]*>"
)
_TAG = re.compile(rf"<({_NAME})({_ATTRS})[ \t\r\n]*(/?)>")
_ATTR = re.compile(_ATTR)
_COMMENT = re.compile(_COMMENT)
_DOCTYPE = re.compile(r"!(?i:doctype)[ \t\r\n][^<>]*")
_END_TAG = re.compile(rf"/({_NAME})[ \t\r\n]*")
_RAW_END = re.compile(r"/\s*(?i:script|style)")
_RAW, _TEXT_ONLY = {"script", "style"}, {"title", "textarea"}
_HOLDERS = _RAW | _TEXT_ONLY
_UNCLEAR = set("xmp iframe noembed noframes noscript plaintext svg math".split())
# Tags as they are spelled repeat within a site; so many different ones, none of them long, are kept.
_KNOWN_TAGS, _KNOWN_LENGTH = 4096, 256


class Tag:
    """A start tag: what an element is made of, and the things by which a :class:`Plan` lists it (``keys``).

    ``plan`` is the plan that looked at it last, with what that found.
    """

    __slots__ = ("name", "attrs", "classes", "keys", "void", "ends", "plan", "direct", "steps")

    def __init__(self, name: str, attrs: list):
        self.name = name
        self.attrs = attrs = {k: v or "" for k, v in reversed(attrs)}
        self.classes = classes = attrs["class"].split() if "class" in attrs else ()
        self.keys = (("tag", name), *[("attr", k) for k in attrs], *[("cls", c) for c in set(classes)])
        self.void, self.ends = name in _VOID, _ENDS.get(name, ())
        self.plan = None
        self.direct = self.steps = ()


class EndTag:
    __slots__ = ("name",)

    def __init__(self, name: str):
        self.name = name


_COMMENT_MARK = object()
_DOCTYPE_MARK = EndTag("!doctype")  # nothing of that name is ever open
_ROOT = Tag("", [])


class Page:
    """A page as the list of its start tags, end tags, texts and comments, in which an element has the place of its start tag.

    ``starts`` has the places of all elements, and ``ends`` at such a place tells where the element ends: what lies between is
    in it. An end tag that ends nothing becomes None, as the texts around it are one.
    """

    __slots__ = ("events", "starts", "ends", "_parents")

    def __init__(self, events: list):
        self.events, self._parents = events, None
        self.starts = starts = []
        self.ends = ends = [0] * len(events)
        open_, names, counts = [-1], [""], defaultdict(int)  # open elements, their names, and how many there are of a name

        def close_from(level: int, place: int) -> None:
            for element, name in zip(open_[level:], names[level:], strict=True):
                ends[element] = place
                counts[name] -= 1
            del open_[level:], names[level:]

        for place, event in enumerate(events):
            kind = event.__class__
            if kind is Tag:
                for other in event.ends:
                    if counts[other]:
                        close_from(_implied_end(names, event.ends), place)
                        break
                starts.append(place)
                if event.void:
                    ends[place] = place + 1
                else:
                    name = event.name
                    open_.append(place)
                    names.append(name)
                    counts[name] += 1
            elif kind is EndTag:
                name = event.name
                if names[-1] == name:
                    names.pop()
                    ends[open_.pop()] = place
                    counts[name] -= 1
                elif counts[name]:
                    level = len(names) - 1
                    while names[level] != name:
                        level -= 1
                    close_from(level, place)
                else:
                    events[place] = None
        close_from(1, len(events))

    def parents(self) -> dict[int, int]:
        """Place of the parent of every element, -1 for the root."""
        if self._parents is None:
            self._parents, above = {}, [-1]
            for place in self.starts:
                while len(above) > 1 and self.ends[above[-1]] <= place:
                    above.pop()
                self._parents[place] = above[-1]
                above.append(place)
        return self._parents

    def is_first(self, place: int) -> bool:
        """Whether no element of the same parent stands before it."""
        at = bisect_left(self.starts, place)
        return at == 0 or self.ends[self.starts[at - 1]] > place

    def before(self, place: int) -> int | None:
        """The element before one of the same parent. For all elements together this is one way through the page."""
        parents, at = self.parents(), bisect_left(self.starts, place)
        above, other = parents[place], self.starts[at - 1] if at else -1
        if other == above:
            return None
        while parents[other] != above:
            other = parents[other]
        return other


def _implied_end(names: list[str], ends: set) -> int:
    """Level of the outermost open element that a start tag ends; behind the last one if it ends none."""
    outermost = level = len(names)
    while level > 1 and ((name := names[level - 1]) not in _SCOPE or name in ends):
        level -= 1
        if name in ends:
            outermost = level
    return outermost


class Element:
    """One element of a page, or its root, which has the place -1."""

    __slots__ = ("page", "place")

    def __init__(self, page: Page, place: int):
        self.page, self.place = page, place

    @property
    def made_of(self) -> Tag:
        return self.page.events[self.place] if self.place >= 0 else _ROOT

    @property
    def tag(self) -> str:
        return self.made_of.name

    @property
    def attrs(self) -> dict:
        return self.made_of.attrs

    @property
    def classes(self) -> list:
        return self.made_of.classes

    @property
    def parent(self) -> Element | None:
        return Element(self.page, self.page.parents()[self.place]) if self.place >= 0 else None

    @property
    def before(self) -> Element | None:
        other = self.page.before(self.place) if self.place >= 0 else None
        return None if other is None else Element(self.page, other)

    def _inside(self, into: Callable[[Tag], bool]) -> list:
        """Texts in this element, and elements that are not gone into. A lone "<" or an end tag without effect does not part texts."""
        events, ends = self.page.events, self.page.ends
        at, end = self.place + 1, ends[self.place] if self.place >= 0 else len(events)
        found, joins = [], False
        while at < end:
            event = events[at]
            kind = event.__class__
            if kind is str:
                if joins:
                    found[-1] += event
                else:
                    found.append(event)
                joins = True
            elif event is not None:
                joins = False
                if kind is Tag and not into(event):
                    found.append(Element(self.page, at))
                    at = ends[at]
                    continue
            at += 1
        return found

    @property
    def children(self) -> list:
        """Elements and texts right below this one."""
        return self._inside(lambda tag: False)

    def text(self) -> str:
        """Stripped text pieces, joined without a separator."""
        page, place = self.page, self.place
        if place >= 0 and page.ends[place] == place + 2 and (only := page.events[place + 1]).__class__ is str:
            return only.strip()
        return "".join([t.strip() for t in self._inside(lambda tag: tag.name not in _NO_TEXT) if t.__class__ is str])


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.events = []

    def handle_starttag(self, tag, attrs):
        self.events.append(Tag(tag, attrs))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.events.append(EndTag(tag))

    def handle_data(self, data):
        self.events.append(data)

    def handle_comment(self, data):
        self.events.append(_COMMENT_MARK)


def _start_tag(found: re.Match) -> Tag:
    attrs = []
    for name, double, single, bare in _ATTR.findall(found[2]):
        value = double or single or bare
        attrs.append((name.lower(), unescape(value) if "&" in value else value))
    return Tag(found[1].lower(), attrs)


def _text(data: str) -> str:
    return unescape(data) if "&" in data else data


def _cut(html: str, known: dict) -> list | None:
    """Events of a page that is made of plain pieces without a "<" inside of a tag; None for any other page."""
    pieces = iter(html.split("<"))
    text = next(pieces)
    events = [_text(text)] if text else []
    get, add = known.get, events.append
    for piece in pieces:
        spelled, closed, text = piece.partition(">")
        event = get(spelled)
        if event is not None and closed:
            add(event)
        else:
            text = _cut_new(piece, spelled, closed, text, pieces, events, known)
            if text is None:
                return None
        if text:
            add(unescape(text) if "&" in text else text)
    return events


def _cut_new(piece: str, spelled: str, closed: str, text: str, pieces: Iterator[str], events: list, known: dict) -> str | None:
    """Adds what a piece behind a "<" begins with, which may take more pieces, and returns the text behind it; None if it is not plain.

    ``spelled`` and ``text`` are the piece before and behind its first ">" (``closed``).
    """
    if spelled.startswith("!--"):
        parts = [piece]
        while "-->" not in parts[-1]:
            if (more := next(pieces, None)) is None:
                return None
            parts.append(more)
        whole = "<".join(parts)
        found = _COMMENT.match(whole)
        events.append(_COMMENT_MARK)
        return whole[found.end() :] if found else None
    if not closed:
        return None
    # Tags of elements that hold no tags are kept too, but under another name.
    event = known.get(holder := "<" + spelled)
    if event is None:
        if spelled.startswith(("/", "!")):
            if found := _END_TAG.fullmatch(spelled):
                event = EndTag(found[1].lower())
            elif _DOCTYPE.fullmatch(spelled):
                event = _DOCTYPE_MARK
            else:
                return None
            _keep(known, spelled, event)
            events.append(event)
            return text
        found = _TAG.match("<" + piece)
        if found is None:
            return None
        event = _start_tag(found)
        whole = found.end() == len(spelled) + 2  # else there is a ">" inside of the tag
        if not whole:
            text = piece[found.end() - 1 :]
        if event.name not in _HOLDERS:
            if event.name in _UNCLEAR:
                return None
            if whole:
                _keep(known, spelled, event)
            events.append(event)
            return text
        if found[3]:
            return None
        if whole:
            _keep(known, holder, event)
    if event.name in _RAW:
        return _raw_text(text, event, pieces, events)
    spelled, closed, behind = next(pieces, "").partition(">")
    found = closed and _END_TAG.fullmatch(spelled)
    if not found or found[1].lower() not in _TEXT_ONLY:
        return None
    events += [event, *([_text(text)] if text else []), EndTag(found[1].lower())]
    return behind


def _raw_text(text: str, tag: Tag, pieces: Iterator[str], events: list) -> str | None:
    """Adds a script or style up to its end tag, and returns the text behind it; None if something could end or hide it."""
    parts = [text]
    for piece in pieces:
        if piece.startswith("!"):
            return None
        if _RAW_END.match(piece):
            spelled, closed, behind = piece.partition(">")
            found = closed and _END_TAG.fullmatch(spelled)
            if not found or found[1].lower() != tag.name:
                return None
            raw = "<".join(parts)
            events += [tag, raw, EndTag(tag.name)] if raw else [tag, EndTag(tag.name)]
            return behind
        parts.append(piece)
    return None


def _keep(known: dict, spelled: str, event: Tag | EndTag) -> None:
    if len(spelled) <= _KNOWN_LENGTH:
        if len(known) >= _KNOWN_TAGS:
            known.clear()
        known[spelled] = event


def _cut_by_pieces(html: str) -> list | None:
    """Events of a page that is made of plain pieces; None for any other page."""
    pieces = _PIECE.findall(html)
    if sum(map(len, pieces)) != len(html):
        return None
    events = []
    for piece in pieces:
        if piece[0] != "<":
            events.append(_text(piece))
        elif piece[1] == "/":
            events.append(EndTag(piece[2:-1].rstrip().lower()))
        elif piece[1] == "!":
            if piece[2] == "-":
                events.append(_COMMENT_MARK)
        else:
            found = _TAG.match(piece)
            events.append(tag := _start_tag(found))
            if found.end() < len(piece):  # a script or style, with its text
                if raw := piece[found.end() : piece.rindex("</")]:
                    events.append(raw)
                events.append(EndTag(tag.name))
    return events


def read_page(html: str, known: dict | None = None) -> Element:
    """Root of a page. ``known`` keeps tags that were read, for the pages that a task reads one after another."""
    events = _cut(html, {} if known is None else known)
    if events is None:
        events = _cut_by_pieces(html)
    return read_any_page(html) if events is None else Element(Page(events), -1)


def read_any_page(html: str) -> Element:
    """Root of a page of whatever markup, by the standard parser."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return Element(Page(builder.events), -1)


class Tests(list):
    """Simple tests of one element, with the things they name (``keys``)."""

    def __init__(self, tests):
        super().__init__(tests)
        self.keys = [key for tag, cls, attr, *_ in tests for key in (("tag", tag), ("cls", cls), ("attr", attr)) if key[1]]


def selector_chains(group: str) -> list:
    """Group of selectors as chains of (relation, simple tests), the target first.

    Raises ``ValueError`` for anything but the supported syntax, as a selector that is read in part
    would match something else than its author meant.
    """
    chains = []
    for selector in group.split(","):
        parts = re.split(r"\s*(\+)\s*|\s+", selector.strip())
        steps, relation = [], " "
        for part in parts:
            if part == "+":
                relation = "+"
            elif part:
                if not _WHOLE.fullmatch(part):
                    raise ValueError(f"unsupported selector {part!r} in {group!r}")
                tests = Tests([m.group("tag", "cls", "attr", "op", "val", "first") for m in _SIMPLE.finditer(part)])
                steps.append((relation, tests))
                relation = " "
        if not steps or relation == "+" or steps[0][0] == "+":
            raise ValueError(f"incomplete selector in {group!r}")
        chains.append(steps[::-1])
    return chains


class Plan:
    """Groups of selectors to be matched in one pass over the elements of a page.

    What a start tag tells by itself is found once per tag: the groups it fits alone (``direct``), and the places in chains
    of selectors that it fits if the elements above or before it do (``steps``).
    """

    def __init__(self, groups: list[list]):
        self.groups = {id(group): group for group in groups}
        # For a page without any of them.
        self.none: dict[int, Sequence[int]] = dict.fromkeys(self.groups, ())
        self._by_key: dict[tuple | None, list] = {}
        self.slots = 0
        for order, group in enumerate(groups):
            for chain in group:
                above = None  # slot of the place above, which is the next one of the chain
                for place in range(len(chain) - 1, -1, -1):
                    relation, tests = chain[place]
                    below = chain[place - 1][0] if place else None
                    slot = self.slots if place else None
                    # Targets go before what may lie above them, as no element lies above itself.
                    step = (place, order, id(group), slot, below == "+", above, relation == "+", any(t[5] for t in tests))
                    key = next((k for kind in ("cls", "attr", "tag") for k in tests.keys if k[0] == kind), None)
                    # What is listed under a key need not be tested for it again.
                    rest = [t[:5] for t in tests if any(t[:3]) and (t[3] or key not in (("tag", t[0]), ("cls", t[1]), ("attr", t[2])))]
                    self._by_key.setdefault(key, []).append((rest, step))
                    above = slot
                    self.slots += bool(place)

    def look_at(self, tag: Tag) -> None:
        direct, steps, by_key = [], [], self._by_key
        for key in (None, *tag.keys):
            for tests, step in by_key.get(key, ()):
                for test in tests:
                    if not _fits_tag(tag, *test):
                        break
                else:
                    place, _, group, _, _, above, _, first = step
                    if place or above is not None or first:
                        steps.append(step)
                    elif group not in direct:
                        direct.append(group)
        tag.plan, tag.direct, tag.steps = self, direct, steps
        if steps:
            tag.steps = sorted((step for step in steps if step[0] or step[2] not in direct), key=lambda step: step[:2])


def _fits_tag(tag: Tag, name: str, cls: str, attr: str, op: str, wanted: str) -> bool:
    """Whether an element with this tag fits a simple test, if its place does not matter."""
    if name:
        return tag.name == name
    if cls:
        return cls in tag.classes
    value = tag.attrs.get(attr)
    return value is not None and (op != "=" or value == wanted) and (op != "*=" or wanted in value)


def _fits_one(element: Element, tests: list) -> bool:
    return all(element.before is None if first else _fits_tag(element.made_of, *test) for *test, first in tests)


class Matches:
    """Which elements of a page fit which selectors; the groups of a plan are matched together, any other when it is asked for.

    Elements are known by their places, so that those inside an element are a range of places. These nest, so an element lies
    inside one that fits the upper part of a selector if one of those before it ends behind it, however deep the page is nested.
    """

    def __init__(self, root: Element, plan: Plan | None = None):
        self.page = root.page
        # The plans are kept, so that no other groups can get the identity of their own.
        self._plans, self._known = [], {}
        if plan is not None:
            self._match(plan)

    @property
    def elements(self) -> list[Element]:
        return [Element(self.page, place) for place in self.page.starts]

    def _match(self, plan: Plan) -> None:
        self._plans.append(plan)
        known = self._known = self._known | plan.none
        events, reach, before = self.page.events, None, {}
        for place in self.page.starts:
            tag = events[place]
            if tag.plan is not plan:
                plan.look_at(tag)
            if tag.direct:
                for group in tag.direct:
                    if known[group]:
                        known[group].append(place)
                    else:
                        known[group] = [place]
            if tag.steps:
                if reach is None:
                    reach = [-1] * plan.slots
                self._step(tag.steps, place, reach, before)

    def _step(self, steps: list[tuple], place: int, reach: list[int], before: dict[int, set[int]]) -> None:
        """Takes an element to the parts of selectors that it fits; ``reach`` is how far those that fit a part go."""
        for _, _, group, slot, asked_beside, above, beside, first in steps:
            if above is not None and not beside and reach[above] <= place:
                continue
            if first and not self.page.is_first(place) or beside and self.page.before(place) not in before.get(above, ()):
                continue
            if slot is None:
                found = self._known[group]
                if not found:
                    self._known[group] = [place]
                elif found[-1] != place:
                    found.append(place)
            elif asked_beside:
                before.setdefault(slot, set()).add(place)
            else:
                reach[slot] = max(reach[slot], self.page.ends[place])

    def _places(self, chains: list) -> Sequence[int]:
        if id(chains) not in self._known:
            self._match(Plan([chains]))
        return self._known[id(chains)]

    def _numbers(self, chains: list) -> list[int]:
        """The elements that fit, by their numbers in document order."""
        return [bisect_left(self.page.starts, place) for place in self._places(chains)]

    def all(self, tiers: list) -> list[Element]:
        """Every element that fits the first tier with a match. Tiers are given as their :func:`selector_chains`."""
        return next(([Element(self.page, place) for place in found] for t in tiers if (found := self._places(t))), [])

    def first(self, tiers: list, inside: Element | None = None) -> Element | None:
        """First element (below ``inside``, if given) that fits the first tier with such a match."""
        for chains in tiers:
            found = self._known.get(id(chains))
            if found is None:
                found = self._places(chains)
            if found:
                start, end = (0, len(self.page.events)) if inside is None else (inside.place + 1, self.page.ends[inside.place])
                at = bisect_left(found, start)
                if at < len(found) and found[at] < end:
                    return Element(self.page, found[at])
        return None
