"""HTML to blocks of text, each with its place in the page. No tree is built; broken markup gives what a lenient reader would see."""

from __future__ import annotations

import html
import re
import zlib
from typing import NamedTuple

from skytally.llm.common import per_worker

# Elements by what they mean for the text of a page.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}  # no markup inside
SILENT = RAW | {"head", "noscript", "template", "svg", "math", "canvas", "object", "audio", "video", "select", "button", "form", "fieldset", "dialog"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
    "mark", "nobr", "output", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# An element on the left ends at the start of one on the right, unless one of the third set lies between.
ENDS = [
    ({"li"}, {"li"}, {"ul", "ol", "menu"}),
    ({"dt", "dd"}, {"dt", "dd"}, {"dl"}),
    ({"td", "th"}, {"td", "th", "tr"}, {"table"}),
    ({"tr"}, {"tr"}, {"table"}),
    ({"option"}, {"option"}, {"select"}),
]
ENDED_BY = {name: [(ended, between) for ended, by, between in ENDS if name in by] for _, names, _ in ENDS for name in names}
AROUND = {"nav", "aside", "footer", "menu"}
ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form",
}
# Words in a class or id that name what surrounds an article.
AROUND_WORDS = {
    "nav", "navbar", "navigation", "menu", "menus", "breadcrumb", "breadcrumbs", "masthead", "banner", "footer", "sidebar", "aside", "rail",
    "widget", "widgets", "ad", "ads", "advert", "adverts", "advertisement", "advertisements", "advertising", "sponsor", "sponsored",
    "promo", "promoted", "promotion", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter",
    "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended", "recommendations", "trending",
    "popular", "comment", "comments", "commentlist", "reply", "replies", "respond", "disqus", "discussion", "search", "pagination",
    "pager", "toolbar", "skip", "copyright",
}
NOT_WORDS = {"has", "with", "without", "no", "free", "layout"}  # as in "has-sidebar": the element around both

ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
START = re.compile(r"""<([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*+)>""")
NAME = re.compile(r"[^\s/>]*")
RAW_END = {name: re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE) for name in RAW}
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


KNOWN, KNOWN_CHARS = 50_000, 200  # elements that a worker remembers, and characters of their attributes at most


class Block(NamedTuple):
    path: int  # of the element it stands in: a number for its ancestors with their classes
    around: bool  # in a menu, header, footer, sidebar, notice, advert or among comments
    inside: int  # 2 in an article, 1 in the main part, else 0
    text: str


class _Element(NamedTuple):
    name: str
    path: int
    silent: bool
    around: bool
    header: bool  # in a header: of an article its headings count, of a page nothing
    inside: int


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def _child(parent: _Element, name: str, attributes: dict[str, str]) -> _Element:
    words = [w.lower() for w in WORD.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}")]
    role = attributes.get("role", "").strip().lower()
    hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true"
    hidden = hidden or "display:none" in attributes.get("style", "").replace(" ", "").lower()
    around, inside = parent.around, parent.inside
    if name not in {"html", "body", "main"}:
        named = not NOT_WORDS.intersection(words) and bool(AROUND_WORDS.intersection(words))
        around = around or name in AROUND or role in ROLES or named
    if name == "article" and not around:
        inside = 2
    elif name == "main" or role == "main" or attributes.get("itemprop") == "articleBody":
        inside = max(inside, 1)
    header = parent.header or name == "header" or "header" in words
    if name in HEADINGS and inside:
        header = False
    signature = zlib.crc32(" ".join([name, role, *words]).encode())
    path = parent.path if name in INLINE else ((parent.path ^ signature) * 0x9E3779B97F4A7C15 + 1) % (1 << 62)
    return _Element(name, path, parent.silent or name in SILENT or hidden, around, header, inside)


def _element(parent: _Element, name: str, raw: str) -> _Element:
    """``_child`` from the attributes as written. The pages of a host have the same elements, so a worker remembers those."""
    if len(raw) > KNOWN_CHARS:
        return _child(parent, name, _attributes(raw))
    known = per_worker("elements", dict)
    found = known.get((parent, name, raw))
    if found is None:
        if len(known) >= KNOWN:
            known.clear()
        found = known[parent, name, raw] = _child(parent, name, _attributes(raw) if raw.strip(" /") else {})
    return found


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, white space as one space, character references decoded; no block is empty."""
    out: list[Block] = []
    stack = [_Element("", 1, False, False, False, 0)]
    open_names: dict[str, int] = {}
    pieces: list[str] = []

    def flush() -> None:
        if not pieces:
            return
        top = stack[-1]
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            out.append(Block(top.path, top.around or top.header, top.inside, text))

    def pop() -> None:
        name = stack.pop().name
        open_names[name] -= 1

    def close(names: set[str], up_to: set[str]) -> None:
        """End the innermost of ``names`` and all in it, unless one of ``up_to`` is met first."""
        if not any(open_names.get(n) for n in names):
            return
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in names:
                flush()
                while len(stack) > depth:
                    pop()
                return
            if stack[depth].name in up_to:
                return

    def text(raw: str) -> None:
        if raw and not stack[-1].silent:
            pieces.append(html.unescape(raw))

    at = 0
    while True:
        tag = page.find("<", at)
        if tag < 0:
            text(page[at:])
            break
        following = page[tag + 1 : tag + 2]
        if not (following.isascii() and following.isalpha()) and following not in ("/", "!", "?"):
            text(page[at : tag + 1])  # a sign of its own
            at = tag + 1
            continue
        text(page[at:tag])
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            if page.startswith(("<!-->", "<!--->"), tag):
                end = page.find(">", tag) - 2
            if end < 0:
                break  # a comment without an end runs to the end
            at = end + 3
            continue
        if following in "/!?":
            end = page.find(">", tag)
            if end < 0:
                break
            at = end + 1
            name = NAME.match(page, tag + 2, end)[0].lower() if following == "/" else ""
            if name == "p" and not open_names.get("p"):
                flush()  # an end without a start is an empty paragraph
            elif name == "br":
                text(" ")
            elif open_names.get(name):
                if name in INLINE:
                    # A stray inline end must not close the blocks around it.
                    for depth in range(len(stack) - 1, 0, -1):
                        if stack[depth].name not in INLINE:
                            break
                        if stack[depth].name == name:
                            while len(stack) > depth:
                                pop()
                            break
                else:
                    close({name}, set())
            continue
        start = START.match(page, tag)
        if not start:
            break  # a tag without an end runs to the end
        at = start.end()
        name = start[1].lower()
        if name in ("br", "wbr") or name in VOID:
            if name == "hr":
                close({"p"}, {"body"})
                flush()
            elif name != "wbr":
                text(" " if name == "br" else "")
            continue
        if name not in INLINE:
            if open_names.get("p"):
                close({"p"}, {"body", "table", "button", "object"})
            for ended, between in ENDED_BY.get(name, ()):
                close(ended, between)
            flush()
        if name in RAW:
            end = RAW_END[name].search(page, at)
            at = len(page) if end is None else end.start()
        stack.append(_element(stack[-1], name, start[2]))
        open_names[name] = open_names.get(name, 0) + 1
    flush()
    return out
