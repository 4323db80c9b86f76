"""Pages as sequences of leaf blocks: a tolerant reader of HTML that keeps each block's tag path and its whole text.

Whatever a page leaves open or unbalanced, the reader goes through it once: open elements are counted by name, so that
none is looked for that isn't there, and elements nested deeper than ``DEPTH`` follow each other instead, as in browsers.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

#: Elements by what they do to the text around them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
#: Elements that are not shown: those whose content is no markup run to the end of the page if they are not ended.
RAW = ("script", "style", "iframe", "noframes", "textarea")
PAIRED = ("template", "object", "svg", "math", "canvas", "audio", "video")
#: What may start within a head; all else ends it.
IN_HEAD = frozenset("html head base basefont bgsound link meta title noscript noframes style script template".split())
#: An opening tag ends an open element of the second group, within an element of the third.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
#: Elements whose start ends an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu "
    "nav ol p pre section table ul".split()
)

_UNSHOWN = re.compile(r"<!--|<!\[CDATA\[|<(/?)(%s)(?=[\s/>])[^>]*>" % "|".join((*RAW, *PAIRED, "noscript")), re.I)
_ENDS = {"<!--": re.compile("-->"), "<![CDATA[": re.compile(r"\]\]>")} | {x: re.compile(rf"</{x}\s*>", re.I) for x in RAW}
_NOSCRIPT = re.compile(r"<(/?)noscript(?=[\s/>])[^>]*>", re.I)
#: How deep elements are nested at most, and words that one tag's names give.
DEPTH, NAMES = 256, 40
_NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)|[!?]")
#: What a tag ends with, or a value in quotes begins with.
_STOP = re.compile(r">|=\s*[\"']")
_NAMES = re.compile(r"(?:^|[\s\"'])(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|[\s\"'])hidden(?:[\s=/]|$)|display\s*:\s*none", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def names_of(attributes: str) -> tuple[str, ...]:
    """Words of the class, id and role of a tag."""
    found = []
    for m in _NAMES.finditer(attributes):
        found += [p.lower() for p in _PART.findall(m[2] or m[3] or m[4] or "")]
        if len(found) > NAMES:
            break
    return tuple(found[:NAMES])


def _shown(page: str) -> str:
    """The page without comments and elements that are not shown. Of an element without an end only its tag is left out,
    unless its content is no markup."""
    spans: list[tuple[int, int]] = []
    open_: dict[str, list[int]] = {}
    endless: dict[str, list[int]] = {}
    # Behind the last > no tag ends, so none is looked for there.
    at, last = 0, max(page.rfind(">"), page.rfind("<!--") + 3, page.rfind("<![CDATA[") + 8) + 1
    while m := _UNSHOWN.search(page, at, last):
        at, name = m.end(), (m[2] or m[0]).lower().replace("cdata", "CDATA")
        if m[1]:
            if open_.get(name):
                spans.append((open_[name].pop(), at))
            continue
        end = None
        if m[0].endswith("/>"):
            pass
        elif name == "noscript":
            end = _NOSCRIPT.search(page, at, last)
            end = end if end and end[1] else None
        elif name in PAIRED:
            open_.setdefault(name, []).append(m.start())
        else:
            end = None if name in endless else _ENDS[name].search(page, at)
            if not end:
                endless.setdefault(name, []).append(m.start())
        at = end.end() if end else at
        spans.append((m.start(), at))
    # What has no end runs to that of the page, if it is not within an element that has one.
    spans += [(k, -1) for starts in endless.values() for k in starts]
    shown, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            shown.append(page[at:a])
            if b < 0:
                return "".join(shown)
        at = max(at, b)
    shown.append(page[at:])
    return "".join(shown)


def _end(page: str, at: int, last: int) -> int:
    """Where a tag ends whose name ends ``at``. A value's closing quote is one that the tag or a space follows; a quote
    without such a partner is a letter like any other."""
    while True:
        stop = _STOP.search(page, at)
        if stop[0] == ">":
            return stop.start()
        at = stop.end()
        close = page.find(stop[0][-1], at, last)
        if close >= 0 and (page[close + 1] in "/>" or page[close + 1].isspace()):
            at = close + 1


def _tags(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(begin, end, whether it is an end tag, name, attributes) of each tag; declarations have no name."""
    last = page.rfind(">")
    at = page.find("<")
    while 0 <= at < last:
        m = _NAME.match(page, at + 1)
        if not m:
            at = page.find("<", at + 1)
            continue
        end = _end(page, m.end(), last) if m[2] else page.find(">", m.end())
        yield at, end + 1, bool(m[1]), (m[2] or "").lower(), page[m.end() : end]
        at = page.find("<", end + 1)


class _Element:
    """An open element that is not inline, with the inline ones open within it."""

    __slots__ = ("tag", "path", "inline")

    def __init__(self, tag: str, path: tuple[str, ...]):
        self.tag, self.path = tag, path
        self.inline: dict[str, int] = {}

    def within(self) -> tuple[str, ...]:
        """The path of what it holds."""
        return self.path + tuple(f"<{tag}" for tag in ("a", "label") if self.inline.get(tag))


class _Reading:
    """The elements that are open, and the blocks found so far."""

    def __init__(self):
        self.open = [_Element("", ())]
        self.count: dict[str, int] = {}
        self.links = 0
        self.found: list[tuple[tuple[str, ...], str, int]] = []
        self.pieces: list[str] = []
        self.linked = 0

    def text(self, piece: str) -> None:
        self.pieces.append(piece)
        if self.links:
            self.linked += len(piece.strip())

    def end_block(self) -> None:
        if self.pieces:
            text = " ".join(html.unescape("".join(self.pieces)).split())
            if text and not self.count.get("head") and not self.count.get("title"):
                self.found.append((self.open[-1].within(), text, self.linked))
            self.pieces.clear()
        self.linked = 0

    def push(self, tag: str, names: tuple[str, ...]) -> None:
        if len(self.open) > DEPTH:
            self.pop()
        self.open.append(_Element(tag, (*self.open[-1].within(), *names)))
        self.count[tag] = self.count.get(tag, 0) + 1

    def pop(self) -> str:
        gone = self.open.pop()
        self.count[gone.tag] -= 1
        self.links -= gone.inline.get("a", 0)
        return gone.tag

    def pop_to(self, tags) -> None:
        """Closes all up to the innermost element of one of these names, one of which is open."""
        while self.pop() not in tags:
            pass

    def inline(self, tag: str, change: int) -> None:
        now = self.open[-1].inline
        if change > 0 or now.get(tag):
            now[tag] = now.get(tag, 0) + change
            self.links += change * (tag == "a")

    def has(self, tags) -> bool:
        return any(self.count.get(tag) for tag in tags)

    def nearer(self, tags, than) -> bool:
        """Whether the innermost open element of either group is one of ``tags``."""
        return next((e.tag in tags for e in reversed(self.open) if e.tag in tags or e.tag in than), False)


def blocks(page: str | None) -> list[tuple[tuple[str, ...], str, int]]:
    """(path, text, letters within links) of each leaf block that has text; the head's blocks are left out."""
    page = _shown(page) if page and "<" in page else page or ""
    r, at = _Reading(), 0

    def left() -> None:
        """What is no part of a head closes it, unless its title is open."""
        if r.count.get("head") and r.open[-1].tag != "title":
            r.end_block()
            r.pop_to({"head"})

    for begin, end, closes, tag, attributes in _tags(page):
        if begin > at:
            piece = page[at:begin]
            if r.count.get("head") and piece.strip(" \t\n\r\f"):
                left()
            r.text(piece)
        at = end
        if not tag:
            continue
        if r.count.get("head") and not closes and tag not in IN_HEAD:
            left()
        if tag in INLINE:
            if closes:
                r.inline(tag, -1)
            elif not attributes.endswith("/"):
                r.inline(tag, 1)
            continue
        r.end_block()
        if closes:
            if r.count.get(tag):
                r.pop_to({tag})
            continue
        if tag in VOID:
            continue
        if tag in ENDS_P and r.open[-1].tag == "p":
            r.pop()
        if tag in ENDED_BY:
            ends, within = ENDED_BY[tag]
            if r.has(ends) and r.nearer(ends, within):
                r.pop_to(ends)
        if not attributes.endswith("/"):
            hidden = ("hidden",) if attributes and _HIDDEN.search(attributes) else ()
            r.push(tag, (f"<{tag}", *(names_of(attributes) if attributes else ()), *hidden))
    if at < len(page):
        if page[at:].strip(" \t\n\r\f"):
            left()
        r.text(page[at:])
    r.end_block()
    return r.found
