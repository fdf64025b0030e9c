"""Block structure of an HTML page: a light tree of block elements and text leaves.

Inline tags only end nothing: their text joins the running leaf. A leaf is the
text between two block boundaries, with character references decoded and white
space turned into single blanks. Text of scripts, styles, templates, form
controls and the like never becomes a leaf; that of formulas does. Tag soup is
accepted: missing end tags, stray ends, unclosed comments and quotes. Only
elements that HTML reads as raw text take the rest of the page without an end
tag; other dropped elements without one within their enclosing block end at the
next block boundary.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

# Element names of the HTML standard.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split())
RAW = frozenset("script style textarea title iframe xmp".split())  # no markup inside
DROPPED = frozenset("template noscript object svg canvas audio video select button annotation annotation-xml".split())
FOREIGN = frozenset("svg math".split())  # "/>" closes them and what is in them
CLOSES_P = BLOCKS - frozenset("body html caption tbody td tfoot th thead tr legend".split())
CLOSES_SAME = {"li": ("li", ("ul", "ol", "menu", "dir")), "dd": ("dd dt", ("dl",)), "dt": ("dd dt", ("dl",)),
               "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table"))}

_TOKEN = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*+(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for t in RAW}
# Deeper block elements are read as part of their parent, so that features stay bounded.
MAX_DEPTH = 400


def _tokens(html: str) -> list[tuple[str, str, int, int, str]]:
    """(kind, tag, first, end, attributes) of every tag and comment; a raw element with its text is one token."""
    out, at, foreign = [], 0, Counter()
    while m := _TOKEN.search(html, at):
        at = m.end()
        if name := m[1] or m[3]:
            tag, attrs = name.lower(), m[2] or m[4] or ""
            closed = attrs.endswith("/")
            if tag in RAW:
                if not (closed and any(foreign.values())):
                    close = _RAW_END[tag].search(html, at)
                    at = close.end() if close else len(html)
                out.append(("raw", tag, m.start(), at, ""))
            else:
                if tag in FOREIGN and not closed:
                    foreign[tag] += 1
                out.append(("start", tag, m.start(), at, attrs))
        elif m[5]:
            tag = m[5].lower()
            if foreign[tag]:
                foreign[tag] -= 1
            out.append(("end", tag, m.start(), at, ""))
        else:
            out.append(("other", "", m.start(), at, ""))
    return out


def _dropped(tokens: list) -> dict[int, int]:
    """{start token: end token} of the dropped elements that end within their enclosing block."""
    out: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    held: Counter = Counter()  # open elements by name, so that a stray end tag needs no search
    for k, (kind, tag, _, _, attrs) in enumerate(tokens):
        if tag not in DROPPED and tag not in BLOCKS:
            continue
        if kind == "start":
            if attrs.endswith("/") and (tag in FOREIGN or tag in DROPPED and held["svg"]):
                out[k] = k
                continue
            if stack and stack[-1][0] == "p" and tag in CLOSES_P:
                held[stack.pop()[0]] -= 1
            if tag != "hr":
                stack.append((tag, k))
                held[tag] += 1
        elif kind == "end" and held[tag]:
            while True:
                name, at = stack.pop()
                held[name] -= 1
                if name == tag:
                    break
            if tag in DROPPED:
                out[at] = k
    return out


class Page:
    """Nodes in page order: parent, tag ("#" for a text leaf), attributes, text, link characters."""

    __slots__ = ("parent", "tag", "attrs", "text", "links", "depth", "below", "held")

    def __init__(self, html: str | None):
        self.parent, self.tag, self.attrs, self.text, self.links, self.depth = [-1], ["#root"], [""], [""], [0], [0]
        # open elements below the depth that gets nodes, and how many of each name
        self.below: list[str] = []
        self.held: Counter = Counter()
        self._parse(html or "")

    def _node(self, parent: int, tag: str, attrs: str, text: str = "", links: int = 0) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.text.append(text)
        self.links.append(links)
        self.depth.append(self.depth[parent] + 1)
        return len(self.tag) - 1

    def _parse(self, html: str) -> None:
        stack, at, end = [0], 0, len(html)
        run: list[str] = []
        linked: list[str] = []
        in_link = False

        def text(raw: str) -> None:
            if raw:
                run.append(raw)
                if in_link:
                    linked.append(raw)

        def flush() -> None:
            if run:
                raw = "".join(run)
                clean = " ".join((unescape(raw) if "&" in raw else raw).split())
                if clean:
                    self._node(stack[-1], "#", "", clean, min(len(clean), sum(map(len, linked))))
                run.clear()
                linked.clear()

        tokens = _tokens(html)
        skip = _dropped(tokens)
        mute = False  # in a dropped element without an end tag
        k = 0
        while k < len(tokens):
            kind, tag, first, at_, attrs = tokens[k]
            if not mute:
                text(html[at:first])
            at = at_
            if kind == "raw":
                if tag not in ("script", "style", "title"):
                    run.append(" ")
            elif tag in BLOCKS:
                mute = False
                flush()
                in_link = False
                if kind == "start":
                    self._open(stack, tag, attrs)
                elif self.held[tag]:  # ends an element without a node
                    self._rise(tag)
                else:
                    for j in range(len(stack) - 1, 0, -1):
                        if self.tag[stack[j]] == tag:
                            del stack[j:]
                            self.below.clear()
                            self.held.clear()
                            break
            elif tag == "a":
                in_link = kind == "start"
            elif kind == "start" and tag in DROPPED:
                if tag != "template":
                    run.append(" ")
                if k not in skip:
                    mute = True
                elif skip[k] > k:
                    k = skip[k]
                    at = tokens[k][3]
            elif kind == "start" and tag in ("br", "wbr", "img", "input", "label"):
                run.append(" ")
            k += 1
        if not mute:
            text(html[at:end])
        flush()

    def _rise(self, tag: str) -> None:
        """Close the nearest open element ``tag`` of those without a node, and what is open in it."""
        while True:
            name = self.below.pop()
            self.held[name] -= 1
            if name == tag:
                return

    def _open(self, stack: list[int], tag: str, attrs: str) -> None:
        if self.below:
            if tag in CLOSES_P and self.below[-1] == "p":
                self._rise("p")
            if tag != "hr":
                self.below.append(tag)
                self.held[tag] += 1
            return
        if tag in CLOSES_P:
            self._close(stack, ("p",), ("td", "th", "div", "li", "article", "section", "body", "blockquote"))
        if tag in CLOSES_SAME:
            same, limits = CLOSES_SAME[tag]
            self._close(stack, same.split(), limits)
        if len(stack) <= MAX_DEPTH:
            node = self._node(stack[-1], tag, attrs)
            if tag != "hr":
                stack.append(node)
        elif tag != "hr":
            self.below.append(tag)
            self.held[tag] += 1

    def _close(self, stack: list[int], tags, limits) -> None:
        """Close the nearest open element of ``tags`` unless one of ``limits`` is nearer."""
        for k in range(len(stack) - 1, 0, -1):
            t = self.tag[stack[k]]
            if t in tags:
                del stack[k:]
                if t not in ("td", "th"):
                    return
            elif t in limits:
                return


_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_NAMES = ("class", "id", "role", "itemprop", "aria-label", "data-role", "data-component", "data-testid")


def attribute_words(attrs: str) -> list[str]:
    """Lower-case words of the naming attributes: "sideBar-left" gives side, bar, sidebar, left."""
    if "=" not in attrs:
        return []
    out = []
    for m in _ATTR.finditer(attrs):
        if m[1].lower() in _NAMES:
            for part in re.split(r"[^A-Za-z]+", m[2] or m[3] or m[4] or ""):
                words = [w.lower() for w in _WORD.findall(part)]
                out += words
                if len(words) > 1:
                    out.append("".join(words))
    return out


def name_parts(attrs: str) -> list[list[str]]:
    """Lower-case words of every single class, id or role."""
    names = (v for m in _ATTR.finditer(attrs) if m[1].lower() in _NAMES for v in (m[2] or m[3] or m[4] or "").split())
    return [[w.lower() for w in words] for v in names if (words := _WORD.findall(v))]
