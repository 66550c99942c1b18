"""Web pages as trees of elements and the blocks of text in them.

Markup is read as browsers read it as far as text goes: tags that are never closed, closed twice or nested
wrongly, attributes with and without quotes, raw text, comments, character references without
semicolon, pages that end anywhere.  Every step is one search from where the last one stopped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

# fixed values: kinds of elements
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("iframe noembed noframes script style textarea title xmp".split())
HEAD = set("base head link meta noscript script style template title".split())
BLOCKS = set(
    """address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td
    tfoot th thead tr ul""".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: a paragraph ends before any of these
ENDS_P = BLOCKS - set("body button caption dd dt html legend optgroup option select tbody td tfoot th thead tr".split()) | {"dd", "dt"}
SCOPE = set("button caption html object table td template th".split())
#: an element of the first kind ends open ones of the second, unless one of the third stands between
ENDS = {
    "li": ({"li"}, BLOCKS - set("address div li p".split())),
    "dd": ({"dd", "dt"}, BLOCKS - set("address dd div dt p".split())),
    "dt": ({"dd", "dt"}, BLOCKS - set("address dd div dt p".split())),
    "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "tfoot", "thead"}, {"table"}),
    "tfoot": ({"tbody", "tfoot", "thead"}, {"table"}),
    "thead": ({"tbody", "tfoot", "thead"}, {"table"}),
}
#: elements nested deeper stand in the last one that is not
DEPTH = 120

_ATTRIBUTE = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?)?"""
_TAG = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)|<([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_ATTRIBUTE})*+)(>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.DOTALL,
)
_PAIR = re.compile(r"""([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+))?)?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Element:
    """``kids`` are elements and texts in order; ``words`` those of class and id, ``attributes`` the others that matter."""

    __slots__ = ("tag", "words", "attributes", "kids", "label")

    def __init__(self, tag: str, attributes: str = "") -> None:
        self.tag, self.kids = tag, []
        self.words, self.attributes = _NONE
        if attributes and not attributes.isspace():
            self.words, self.attributes = _attributes(attributes)
        self.label = f"{tag}.{'.'.join(sorted(self.words))}" if self.words else tag


_NONE: tuple[frozenset, dict] = (frozenset(), {})


def _attributes(text: str) -> tuple[frozenset[str], dict[str, str]]:
    found: dict[str, str] = {}
    for m in _PAIR.finditer(text):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    named = f"{found.pop('class', '')} {found.pop('id', '')}"
    return frozenset(w.lower() for w in _WORD.findall(named)), found


class _Tree:
    def __init__(self) -> None:
        self.root = Element("html")
        self.open = [self.root]
        self.deeper: list[str] = []

    def text(self, text: str) -> None:
        if self.open[-1].tag == "head" and not text.isspace():
            self.close_to(len(self.open) - 1)
        self.open[-1].kids.append(text)

    def close_to(self, depth: int) -> None:
        del self.open[depth:]
        self.deeper.clear()

    def close_any(self, tags: set[str], stops: set[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in tags:
                return self.close_to(i)
            if tag in stops:
                return None
        return None

    def start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body"):
            if tag == "body" and len(self.open) <= 2 and not any(getattr(k, "tag", "") == "body" for k in self.root.kids):
                self.close_to(1)
                self.push(tag, attributes)
            return
        if self.open[-1].tag == "head" and tag not in HEAD:
            self.close_to(len(self.open) - 1)
        if tag in ENDS_P:
            self.close_any({"p"}, SCOPE)
        if tag in ENDS:
            self.close_any(*ENDS[tag])
        elif tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.close_to(len(self.open) - 1)
        self.push(tag, attributes)

    def push(self, tag: str, attributes: str) -> None:
        new = Element(tag, attributes)
        if len(self.open) > DEPTH and tag not in VOID:
            self.deeper.append(tag)
            if tag in BLOCKS:
                self.open[-1].kids.append(Element("hr"))  # still ends a block
            return
        self.open[-1].kids.append(new)
        if tag not in VOID:
            self.open.append(new)

    def end(self, tag: str) -> None:
        if tag in self.deeper:
            while self.deeper.pop() != tag:
                pass
            if tag in BLOCKS:
                self.open[-1].kids.append(Element("hr"))
            return
        if tag in ("html", "body", "br"):
            if tag == "br":
                self.start(tag, "")
            return
        if tag in HEADINGS:
            return self.close_any(HEADINGS, SCOPE)
        # the end of an inline element ends no block, that of a block no table cell
        self.close_any({tag}, (SCOPE if tag not in ("table", "td", "th", "tr", "tbody", "thead", "tfoot") else {"template"}) - {tag} if tag in BLOCKS else BLOCKS)


def parse(html: str) -> Element:
    """The tree of a page; an empty text gives an empty root."""
    tree, at, size = _Tree(), 0, len(html)
    while at < size:
        m = _TAG.search(html, at)
        if m is None:
            tree.text(unescape(html[at:]))
            break
        if m.start() > at:
            text = html[at : m.start()]
            tree.text(unescape(text) if "&" in text else text)
        at = m.end()
        if m[1]:
            tree.end(m[1].lower())
        elif m[2] and m[4]:
            tag = m[2].lower()
            tree.start(tag, m[3])
            if tag in RAW:
                # raw text is no text of the page; it goes to its own end tag
                end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE).search(html, at)
                at = end.start() if end else size
    return tree.root


class Block:
    """A run of text between block elements: the elements around it, outermost first, and the characters in links."""

    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple[Element, ...], linked: int) -> None:
        self.text, self.path, self.linked = text, path, linked


def blocks(root: Element, dropped) -> Iterator[Block]:
    """The blocks of a tree in page order, without elements for which ``dropped(element, path)`` holds.

    White space is one space inside a block and none at its ends.
    """
    held: list[str] = []
    linked: list[str] = []

    def flush(path: tuple[Element, ...]) -> Iterator[Block]:
        if held:
            text = " ".join("".join(held).split())
            if text:
                yield Block(text, path, min(len(text), len(" ".join(" ".join(linked).split()))))
            held.clear()
            linked.clear()

    def walk(element: Element, path: tuple[Element, ...], in_link: bool) -> Iterator[Block]:
        # path: block elements around, the innermost last; all elements that can be dropped are looked at
        for kid in element.kids:
            if isinstance(kid, str):
                held.append(kid)
                if in_link:
                    linked.append(kid)
            elif kid.tag == "br":
                held.append(" ")
            elif kid.tag in BLOCKS:
                yield from flush(path)
                if not dropped(kid, path):
                    inner = (*path, kid)
                    yield from walk(kid, inner, in_link)
                    yield from flush(inner)
            elif not dropped(kid, path):
                yield from walk(kid, path, in_link or kid.tag == "a")

    yield from walk(root, (root,), False)
    yield from flush((root,))
