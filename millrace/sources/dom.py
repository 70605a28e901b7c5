"""A small document tree on the standard library's parser, and the few selectors that page parsers need.

Void elements never nest; an open paragraph, list item, option, row or cell is closed by the next one.
Unclosed elements end with their parent, stray end tags are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that an opening tag of one of the set ends, if one of them is the innermost open element.
SIBLINGS = {"p": {"p"}, "li": {"li"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
HIDDEN = frozenset({"script", "style", "noscript", "template"})


class Node:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def __iter__(self) -> Iterator[Node]:
        """All elements below, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def strings(self, skip: frozenset[str] = frozenset()) -> Iterator[str]:
        stack: list[Node | str] = list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                yield x
            elif x.tag not in skip:
                stack += reversed(x.children)

    def text(self, skip: frozenset[str] = frozenset()) -> str:
        """All strings with single spaces between words."""
        return " ".join(" ".join(self.strings(skip)).split())


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.open.tag in SIBLINGS.get(tag, ()) and self.open.parent:
            self.open = self.open.parent
            if tag == "tr" and self.open.tag == "tr" and self.open.parent:
                self.open = self.open.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.open)
        self.open.children.append(node)
        if tag not in VOID:
            self.open = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.open.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.open))

    def handle_endtag(self, tag: str) -> None:
        node: Node | None = self.open
        while node and node.tag != tag:
            node = node.parent
        if node and node.parent:
            self.open = node.parent

    def handle_data(self, data: str) -> None:
        self.open.children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


_SIMPLE = re.compile(r"""^([a-z0-9]*)((?:\[[^\]]+\])*)$""")
_ATTR = re.compile(r"""\[([a-z:-]+)(?:(\^?=)"([^"]*)")?\]""")
_compiled: dict[str, list[list[tuple[str, list[tuple[str, str, str]]]]]] = {}


def _selector(css: str) -> list[list[tuple[str, list[tuple[str, str, str]]]]]:
    if css not in _compiled:
        paths = []
        for path in css.split(","):
            steps = []
            for simple in path.split():
                m = _SIMPLE.match(simple)
                if not m:
                    raise ValueError(f"selector {simple!r} is not supported")
                steps.append((m[1], _ATTR.findall(m[2])))
            paths.append(steps)
        _compiled[css] = paths
    return _compiled[css]


def _fits(node: Node, step: tuple[str, list[tuple[str, str, str]]]) -> bool:
    tag, tests = step
    if tag and node.tag != tag:
        return False
    for name, how, value in tests:
        got = node.attrs.get(name)
        if got is None or how == "=" and got != value or how == "^=" and not got.startswith(value):
            return False
    return True


def _ends(node: Node, steps: list) -> bool:
    if not _fits(node, steps[-1]):
        return False
    left, above = len(steps) - 2, node.parent
    while left >= 0 and above:
        if _fits(above, steps[left]):
            left -= 1
        above = above.parent
    return left < 0


def select(node: Node, css: str) -> Iterator[Node]:
    """Elements below that one of the comma-separated paths of `tag[attr="v"][attr^="v"]` steps leads to."""
    paths = _selector(css)
    return (x for x in node if any(_ends(x, steps) for steps in paths))


def first(node: Node, css: str) -> Node | None:
    return next(select(node, css), None)


def first_text(node: Node | None, css: str) -> str:
    found = first(node, css) if node else None
    return found.text() if found else ""
