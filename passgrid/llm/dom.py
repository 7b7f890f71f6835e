"""A small tolerant reader of HTML: elements in page order with their parents, and the text between tags."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html import unescape

# What follows a tag's name. A quote opens a value right after an equals sign only. Possessive, so no text is read twice.
_REST = r"""(?P<rest>(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)*+)>"""
_SIMPLE_REST = r"(?P<rest>[^>]*+)>"


def _markup(rest: str) -> re.Pattern:
    return re.compile(
        r"<!--.*?(?:-->|\Z)"
        r"|<(?P<raw>script|style|textarea|iframe|title)(?=[\s/>])[^>]*+>"
        rf"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+){rest}"
        r"|<[!?/][^>]*+>",
        re.DOTALL | re.IGNORECASE,
    )


def _unseen(rest: str) -> re.Pattern:
    return re.compile(
        rf"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>svg|object|template)(?=[\s/>]){rest}", re.DOTALL | re.IGNORECASE
    )


_MARKUP, _SIMPLE_MARKUP = _markup(_REST), _markup(_SIMPLE_REST)
_UNSEEN, _SIMPLE_UNSEEN = _unseen(_REST), _unseen(_SIMPLE_REST)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.IGNORECASE)
_SPACE = re.compile(r"\s+")
# ---- Fixed values: element kinds of HTML ---------------------------------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
# A start tag that ends an open element of the same list, within the given scope.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr main menu nav ol p pre section table ul li".split()
)


# Unseen elements with markup of their own; noscript ends at its first end tag, whatever stands in it.
UNSEEN = frozenset("svg object template".split())
_RAW_END = {
    name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE)
    for name in ("script", "style", "textarea", "iframe", "title", "noscript")
}


@dataclass
class Element:
    tag: str
    parent: int
    names: str = ""
    hidden: bool = False
    depth: int = 0
    own_text: int = 0
    # Filled for whole subtrees.
    text: int = 0
    linked: int = 0
    words: int = 0
    stops: int = 0
    children: int = 0


@dataclass
class Page:
    elements: list[Element] = field(default_factory=list)
    # Pieces of text as (element, text), a break between blocks as (element, None).
    pieces: list[tuple[int, str | None]] = field(default_factory=list)


def _whole(rest: str) -> bool:
    """Whether the name of a tag ends where ``rest`` begins."""
    return not rest or rest[0] in " \t\n\r\f/"


def _matches(
    html: str, strict: re.Pattern, simple: re.Pattern, reached: Callable[[], int] = lambda: 0
) -> Iterator[re.Match]:
    """Markup in page order, each character looked at a bounded number of times; ``reached`` tells how far the reader
    has come, where that is beyond the match.

    Where a tag has no end because a quote in it never closes, that one and all later tags end at the next ``>``; behind
    the last ``>`` of the page only comments can begin.
    """
    at, last = 0, html.rfind(">")
    pattern = strict
    while (at := html.find("<", at)) >= 0:
        m = None
        if at <= last or html.startswith("<!--", at):
            m = pattern.match(html, at)
            if m is None and pattern is strict and (m := simple.match(html, at)):
                pattern = simple
        elif (at := html.find("<!--", at)) < 0:
            break
        else:
            continue
        if m is None:
            at += 1
            continue
        yield m
        at = max(m.end(), reached())


def _unseen_ends(html: str) -> dict[int, int]:
    """Ends of unseen elements by their beginnings: each end tag balances the last start tag that is still open."""
    ends: dict[int, int] = {}
    open_: dict[str, list[int]] = {name: [] for name in UNSEEN}
    for m in _matches(html, _UNSEEN, _SIMPLE_UNSEEN):
        name = (m["name"] or "").lower()
        if not name:
            continue
        if not m["close"]:
            if name != "svg" or not m["rest"].endswith("/"):
                open_[name].append(m.start())
        elif open_[name]:
            ends[open_[name].pop()] = m.end()
    return ends


def read_page(html: str) -> Page:
    """Elements and text of a page. Scripts, styles, titles, comments and other unseen text are left out. An unclosed
    script, style, title, frame or text field reaches to the end, as in browsers; an empty or unclosed drawing, object,
    template or noscript hides nothing."""
    page = Page([Element("#page", -1)])
    elements, pieces = page.elements, page.pieces
    open_ = [0]
    at, n = 0, len(html)
    # Found when needed: ends of unseen elements, and whether no noscript ends any more.
    ends: dict[int, int] | None = None
    endless = False

    def text(value: str) -> None:
        if value:
            value = unescape(value) if "&" in value else value
            pieces.append((open_[-1], value))

    def close_paragraph() -> None:
        for i in range(len(open_) - 1, 0, -1):
            tag = elements[open_[i]].tag
            if tag == "p":
                del open_[i:]
                return
            if tag not in INLINE:
                return

    for m in _matches(html, _MARKUP, _SIMPLE_MARKUP, lambda: at):
        text(html[at : m.start()])
        at = m.end()
        if m["raw"]:
            name = m["raw"].lower()
            end = _RAW_END[name].search(html, at)
            at = end.end() if end else n
            if name == "textarea":
                pieces.append((open_[-1], None))
            continue
        if not m["name"]:
            continue
        name = m["name"].lower()
        if (name in UNSEEN or name == "noscript") and _whole(m["rest"]):
            if m["close"]:
                continue
            if name == "noscript":
                end = None if endless else _RAW_END[name].search(html, at)
                endless = end is None
                at = end.end() if end else at
            else:
                ends = _unseen_ends(html) if ends is None else ends
                at = ends.get(m.start(), at)
            continue
        if m["close"]:
            if name in INLINE or name == "br":
                for i in range(len(open_) - 1, 0, -1):
                    tag = elements[open_[i]].tag
                    if tag == name:
                        del open_[i:]
                        break
                    if tag not in INLINE:
                        break
            else:
                for i in range(len(open_) - 1, 0, -1):
                    if elements[open_[i]].tag == name:
                        pieces.append((open_[i], None))
                        del open_[i:]
                        break
            if name == "br":
                pieces.append((open_[-1], None))
            continue
        if name == "br":
            pieces.append((open_[-1], None))
            continue
        if name in ENDS_PARAGRAPH:
            close_paragraph()
        if name in ENDS:
            ended, scope = ENDS[name]
            for i in range(len(open_) - 1, 0, -1):
                tag = elements[open_[i]].tag
                if tag in ended:
                    del open_[i:]
                    break
                if tag in scope:
                    break
        if name not in INLINE:
            pieces.append((open_[-1], None))
        element = Element(name, open_[-1], depth=len(open_))
        if m["rest"]:
            names = []
            for key, value in _ATTRIBUTE.findall(m["rest"]):
                key, value = key.lower(), value.strip("\"'").lower()
                if key in ("class", "id", "role"):
                    names.append(value)
                elif key == "hidden" or (key == "aria-hidden" and value == "true"):
                    element.hidden = True
                elif key == "style" and "display:none" in value.replace(" ", ""):
                    element.hidden = True
            element.names = " ".join(names)
        elements.append(element)
        if name not in VOID and not m["rest"].endswith("/") or name in INLINE - {"img", "wbr"}:
            open_.append(len(elements) - 1)
    text(html[at:])
    _measure(page)
    return page


def _measure(page: Page) -> None:
    elements = page.elements
    in_link = [False] * len(elements)
    for i, e in enumerate(elements):
        if i:
            in_link[i] = e.tag == "a" or in_link[e.parent]
            elements[e.parent].children += 1
    for i, value in page.pieces:
        if value and not value.isspace():
            size = len(value.strip())
            e = elements[i]
            e.own_text += size
            e.text += size
            e.words += value.count(" ") + 1
            e.stops += value.count(".") + value.count(",")
            if in_link[i]:
                e.linked += size
    for e in reversed(elements[1:]):
        p = elements[e.parent]
        p.text += e.text
        p.linked += e.linked
        p.words += e.words
        p.stops += e.stops


def blocks(page: Page, wanted: list[bool]) -> str:
    """Text of the wanted elements: white space in a block as one space, blocks by line feeds."""
    out: list[str] = []
    held: list[str] = []
    for i, value in page.pieces:
        if value is None:
            if held:
                line = _SPACE.sub(" ", "".join(held)).strip()
                if line:
                    out.append(line)
                held = []
        elif wanted[i]:
            held.append(value)
    if held:
        line = _SPACE.sub(" ", "".join(held)).strip()
        if line:
            out.append(line)
    return "\n".join(out)
