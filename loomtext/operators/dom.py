"""A small element tree on the standard library's HTML parser: enough for selecting, dropping and reading text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Open elements that a start tag closes, up to the nearest of the second set.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Start tags that end an open paragraph.
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())


class Element:
    __slots__ = ("name", "attrs", "children", "parent")

    def __init__(self, name: str, attrs: dict[str, str], parent: Element | None):
        self.name, self.attrs, self.parent = name, attrs, parent
        self.children: list[Element | str] = []

    def walk(self) -> Iterator[Element]:
        """Descendants in document order, without itself."""
        stack = [iter(self.children)]
        while stack:
            for c in stack[-1]:
                if isinstance(c, Element):
                    yield c
                    stack.append(iter(c.children))
                    break
            else:
                stack.pop()

    def strings(self) -> Iterator[str]:
        stack = [iter(self.children)]
        while stack:
            for c in stack[-1]:
                if isinstance(c, str):
                    yield c
                else:
                    stack.append(iter(c.children))
                    break
            else:
                stack.pop()

    def text(self, separator: str = " ") -> str:
        """The stripped strings below, without empty ones, joined."""
        return separator.join(s for s in map(str.strip, self.strings()) if s)

    def drop(self) -> None:
        if self.parent is not None:
            self.parent.children = [c for c in self.parent.children if c is not self]
            self.parent = None

    def matches(self, selector: str) -> bool:
        m = _SELECTOR.fullmatch(selector.strip())
        if not m:
            raise ValueError(f"selector not supported: {selector}")
        tag, rest = m[1], m[2]
        if tag and tag not in ("*", self.name):
            return False
        for kind, name, value in _PART.findall(rest):
            if kind == "#" and self.attrs.get("id") != name:
                return False
            if kind == "." and name not in self.attrs.get("class", "").split():
                return False
            if kind == "[" and self.attrs.get(name) != value:
                return False
        return True

    def select(self, selector: str) -> list[Element]:
        return [e for e in self.walk() if e.matches(selector)]

    def first(self, *selectors: str) -> Element | None:
        """The first element of the first selector that has one."""
        for s in selectors:
            for e in self.walk():
                if e.matches(s):
                    return e
        return None


_SELECTOR = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:#[\w-]+|\.[\w-]+|\[[\w-]+=[\"']?[^\]\"']*[\"']?\])*)")
_PART = re.compile(r"([#.\[])([\w-]+)(?:=[\"']?([^\]\"']*)[\"']?\])?")


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("[document]", {}, None)

    def _close(self, names: set[str] | frozenset[str], until: set[str]) -> None:
        e = self.at
        while e.parent is not None and e.name not in until:
            if e.name in names:
                self.at = e.parent
                return
            e = e.parent

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._close({"p"}, {"td", "th", "table", "button", "li"})
        if tag in IMPLIED:
            names, until = IMPLIED[tag]
            for _ in range(2 if tag == "tr" else 1):
                self._close(names, until)
        e = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(e)
        if tag not in VOID:
            self.at = e

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        e = self.at
        while e.parent is not None and e.name != tag:
            e = e.parent
        if e.parent is not None:
            self.at = e.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Element:
    """The tree of a page. Unclosed elements end where their parent does; scripts and styles are text; nothing raises."""
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root
