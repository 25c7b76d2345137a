"""Captured markup as intervals, and a table of fields to take from it.

A page becomes two flat lists in document order: elements, each with the
interval of positions it covers, and text pieces with their positions.  "Inside
an element" is then a comparison of positions: no tree is walked, and nesting
of any depth costs nothing but its tags.

What to take is data: a ``Field`` names a path of selectors and what to read
(an attribute, text, presence), a ``Cards`` names the elements that are one
record each and their fields.  One reader serves all boards; a card that can't
be read becomes an error of its own and the page's other cards are kept.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

# Elements without content, and elements whose end tag HTML lets out: the tag
# that opens, the open elements it ends, and those it doesn't look beyond.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = ("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
          "section table ul").split()
ENDS = {"li": ("li", "ul ol"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table thead tbody tfoot"),
        "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select datalist"),
        **{b: ("p", "div td th li article section body") for b in BLOCKS}}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}
UNREAD = frozenset(("script", "style", "template"))


@dataclass
class Element:
    tag: str
    attrs: dict
    start: int
    end: int = -1

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()


class Page(HTMLParser):
    """Elements and text pieces of one document."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.elements: list[Element] = []
        self.pieces: list[str] = []
        self.places: list[int] = []
        self._open: list[Element] = []
        self._at = 0
        self.feed(html or "")
        self.close()
        self._leave(0)
        self._starts = [e.start for e in self.elements]

    # -- reading the markup
    def _leave(self, depth: int) -> None:
        while len(self._open) > depth:
            self._open.pop().end = self._at

    def _enter(self, tag: str, attrs, stays: bool) -> None:
        ended, border = ENDS.get(tag, ((), ()))
        for depth in range(len(self._open) - 1, -1, -1) if ended else ():
            if self._open[depth].tag in ended:
                self._leave(depth)
                break
            if self._open[depth].tag in border:
                break
        self._at += 1
        e = Element(tag, {k: v or "" for k, v in attrs}, self._at, self._at)
        self.elements.append(e)
        if stays:
            self._open.append(e)

    def handle_starttag(self, tag, attrs):
        self._enter(tag, attrs, tag not in VOID)

    def handle_startendtag(self, tag, attrs):
        self._enter(tag, attrs, False)

    def handle_endtag(self, tag):
        for depth in range(len(self._open) - 1, -1, -1):
            if self._open[depth].tag == tag:
                self._leave(depth)
                return

    def handle_data(self, data):
        self._at += 1
        self.pieces.append(data)
        self.places.append(self._at)

    # -- looking things up
    def whole(self) -> Element:
        return Element("", {}, 0, self._at)

    def inside(self, scope: Element) -> list[Element]:
        return self.elements[bisect_left(self._starts, scope.start + 1):bisect_left(self._starts, scope.end + 1)]

    def text(self, scope: Element, separator: str = "", strip: bool = False, without=frozenset()) -> str:
        """Text pieces in scope, but for those in unread elements."""
        skip = sorted((e.start, e.end) for e in self.inside(scope) if e.tag in UNREAD or e.tag in without)
        out, k = [], 0
        upto = -1  # end of the skipped element that reaches furthest
        for i in range(bisect_left(self.places, scope.start), bisect_left(self.places, scope.end + 1)):
            while k < len(skip) and skip[k][0] <= self.places[i]:
                upto = max(upto, skip[k][1])
                k += 1
            if self.places[i] > upto:
                piece = self.pieces[i].strip() if strip else self.pieces[i]
                if piece or not strip:
                    out.append(piece)
        return separator.join(out)


_STEP = re.compile(r"(?P<tag>[a-z][a-z0-9]*)?(?:#(?P<id>[\w-]+))?(?:\.(?P<cls>[\w-]+))?"
                   r"(?:\[(?P<attr>[\w-]+)(?:(?P<op>\^?=)(?P<value>[^\]]*))?\])?(?::(?P<nth>\d+))?$")


def _step(text: str):
    m = _STEP.match(text)
    if not m:
        raise ValueError(f"not a selector: {text!r}")
    return m.groupdict()


def _fits(e: Element, s: dict) -> bool:
    if s["tag"] and e.tag != s["tag"] or s["id"] and e.attrs.get("id") != s["id"] or s["cls"] and s["cls"] not in e.classes:
        return False
    if s["attr"]:
        v = e.attrs.get(s["attr"])
        if v is None or s["op"] == "=" and v != s["value"] or s["op"] == "^=" and not v.startswith(s["value"]):
            return False
    return True


def select(page: Page, scope: Element, path: str) -> list[Element]:
    """Elements at the end of a path: each step looks inside all that the step before found.

    ``tag#id.class[attr]``, ``[attr=value]``, ``[attr^=prefix]``; ``:k`` keeps
    the k-th (from 0) of what a step found; ``|`` separates paths of which the
    first that finds something counts.
    """
    for one in path.split("|"):
        found = [scope]
        for text in one.split():
            s = _step(text)
            found = [e for x in found for e in page.inside(x) if _fits(e, s)]
            if s["nth"] is not None:
                found = found[int(s["nth"]):int(s["nth"]) + 1]
        if found:
            return found
    return []


@dataclass(frozen=True)
class Field:
    """What to read of a card: from the first element of the path, or of all of them (``many``)."""

    name: str
    path: str = ""  # nothing: the card itself
    attr: str | None = None
    separator: str = ""
    strip: bool = False
    many: bool = False
    present: bool = False  # whether the path finds anything
    required: bool = False  # without it, the card isn't a record
    missing: str | None = None
    without: frozenset = frozenset()
    parts: tuple = ()  # fields of each element: a list of records


@dataclass(frozen=True)
class Cards:
    """Elements that are one record each (nothing: the page is one record)."""

    path: str
    fields: tuple = field(default=())


class NotARecord(Exception):
    pass


def read_field(page: Page, scope: Element, f: Field):
    found = select(page, scope, f.path) if f.path else [scope]
    if f.present:
        return bool(found)
    if f.required and not found:
        raise NotARecord
    if f.parts:
        out = []
        for e in found:
            try:
                out.append({p.name: read_field(page, e, p) for p in f.parts})
            except NotARecord:
                continue
        return out

    def value(e):
        return e.attrs.get(f.attr) if f.attr else page.text(e, f.separator, f.strip, f.without)

    if f.many:
        return [value(e) for e in found]
    return value(found[0]) if found else f.missing


def read_cards(html: str | None, cards: Cards) -> Iterator[tuple[int, dict | None, str | None]]:
    """(position, record, error) of each card of a page; position -1: the page itself can't be read."""
    try:
        if html is None:
            raise ValueError("no html captured")
        page = Page(html)
        found = select(page, page.whole(), cards.path) if cards.path else [page.whole()]
    except Exception as exc:
        yield -1, None, f"{type(exc).__name__}: {exc}"
        return
    at = 0
    for card in found:
        try:
            record = {f.name: read_field(page, card, f) for f in cards.fields}
        except NotARecord:
            continue
        except Exception as exc:
            yield at, None, f"{type(exc).__name__}: {exc}"
        else:
            yield at, record, None
        at += 1
