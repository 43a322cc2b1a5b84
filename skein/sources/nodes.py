"""A topic as a flat node table.

One streaming parse numbers every element and every processing instruction in document order.  A node is an
interval twice over: ``at`` to ``last`` among the ordinals (its subtree), and ``lo`` to ``hi`` in the running
text of the topic.  Containment is a comparison of ordinals, the text of an element is a slice, and the
renderings below are slices with some stretches replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from xml.parsers import expat

#: Tag of a processing instruction in the table; its text is the attribute of the empty name.
MARKER = "?"
_DOCTYPE = re.compile(r"<!DOCTYPE.*?>", re.S)


def squeeze(s: str | None) -> str:
    return " ".join((s or "").split())


def escaped(s: str) -> str:
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


class Nodes:
    """The node table of one document; raises ``expat.ExpatError`` if it is not well-formed."""

    def __init__(self, raw: str):
        self.tag: list[str] = []
        self.attr: list[dict[str, str]] = []
        self.parent: list[int] = []
        self.last: list[int] = []
        self.lo: list[int] = []
        self.hi: list[int] = []
        pieces: list[str] = []
        above, size = [-1], 0

        def begin(tag: str, attr: dict[str, str]) -> None:
            self.parent.append(above[-1])
            above.append(len(self.tag))
            self.tag.append(tag)
            self.attr.append(attr)
            for column in (self.last, self.lo, self.hi):
                column.append(size)

        def end(_: str = "") -> None:
            at = above.pop()
            self.last[at], self.hi[at] = len(self.tag), size

        def text(s: str) -> None:
            nonlocal size
            pieces.append(s)
            size += len(s)

        def marker(target: str, data: str) -> None:
            begin(MARKER, {"": f"{target} {data}"})
            end()

        parser = expat.ParserCreate(namespace_separator="}")
        parser.buffer_text = True
        parser.StartElementHandler, parser.EndElementHandler = begin, end
        parser.CharacterDataHandler, parser.ProcessingInstructionHandler = text, marker
        parser.Parse(_DOCTYPE.sub("", raw), True)
        self.text = "".join(pieces)

    # ---- navigation
    def within(self, at: int, *tags: str) -> Iterator[int]:
        """The node and its descendants in document order, of the given tags if any are given."""
        return (i for i in range(at, self.last[at]) if not tags or self.tag[i] in tags)

    def children(self, at: int, *tags: str) -> Iterator[int]:
        i = at + 1
        while i < self.last[at]:
            if not tags or self.tag[i] in tags:
                yield i
            i = self.last[i]

    def child(self, at: int, *tags: str) -> int | None:
        return next(self.children(at, *tags), None)

    def get(self, at: int, name: str) -> str:
        return self.attr[at].get(name) or ""

    def is_number(self, at: int) -> bool:
        """An automatic number in front of a paragraph or title."""
        return self.tag[at] == "ph" and self.get(at, "props") == "autonumber"

    def kind(self, at: int, tags: set[str], base: str) -> bool:
        """By tag, or by the class that a specialised element derives from."""
        return self.tag[at] in tags or base in self.get(at, "class")

    # ---- text
    def raw(self, at: int) -> str:
        return self.text[self.lo[at] : self.hi[at]]

    def whole(self, at: int) -> str:
        return squeeze(self.raw(at))

    def head(self, at: int) -> str:
        """Text before the first child element."""
        first = next((i for i in self.children(at) if self.tag[i] != MARKER), None)
        return self.text[self.lo[at] : self.hi[at] if first is None else self.lo[first]]

    def replaced(self, at: int, cuts: Iterable[tuple[int, str]]) -> str:
        """Text of a node in which the nodes of ``cuts``, in order, give way to other text."""
        out, pos = [], self.lo[at]
        for node, s in cuts:
            out += [self.text[pos : self.lo[node]], s]
            pos = self.hi[node]
        return "".join(out) + self.text[pos : self.hi[at]]

    def image(self, at: int) -> str:
        href = self.get(at, "href")
        return href.rpartition("/")[2] or href or "image"

    def images(self, nodes: Iterable[int]) -> list[str]:
        """T4: names of the images among nodes, each once."""
        return list(dict.fromkeys(self.image(i) for i in nodes if self.tag[i] == "image"))

    def paragraph(self, at: int) -> str:
        """Its number, then its body."""
        kids = list(self.children(at))
        numbers = [i for i in kids if self.is_number(i)]
        cuts = [(i, "" if i in numbers else f" [IMAGE: {self.image(i)}] ") for i in kids if i in numbers or self.tag[i] == "image"]
        label = squeeze(self.head(numbers[-1])) if numbers else ""
        return squeeze(f"{label} {self.replaced(at, cuts)}")

    def _figure(self, at: int) -> list[str]:
        return [f"[IMAGE: {self.image(i)}]" for i in self.within(at, "image")][:1]

    def _items(self, at: int) -> list[str]:
        return [" ".join(self.blocks(self.children(i))) for i in self.children(at, "li")]

    def table(self, at: int) -> str:
        """A table as minimal HTML with its caption and column spans."""
        caption = squeeze(" ".join(self.raw(i) for i in (self.child(at, "title"), self.child(at, "desc")) if i is not None))
        parts = [_wrapped("caption", escaped(caption))] if caption else []
        group = next(self.within(at, "tgroup"), None)
        if group is not None:
            place: dict[str, int] = {}
            for c in self.children(group, "colspec"):
                if name := self.get(c, "colname"):
                    number = self.get(c, "colnum")
                    place[name] = int(number) if number.isdigit() else len(place) + 1

            def cell(entry: int, tag: str) -> str:
                ends = [place.get(self.get(entry, n)) for n in ("namest", "nameend")]
                width = 1 if None in ends else ends[1] - ends[0] + 1
                return _wrapped(tag, escaped(self.whole(entry)), f' colspan="{width}"' if width > 1 else "")

            for part, tag in (("thead", "th"), ("tbody", "td")):
                block = self.child(group, part)
                if block is not None:
                    rows = ["".join(cell(e, tag) for e in self.children(r, "entry")) for r in self.children(block, "row")]
                    parts.append(_wrapped(part, "".join(_wrapped("tr", r) for r in rows)))
        return _wrapped("table", "".join(parts))

    def blocks(self, nodes: Iterable[int]) -> list[str]:
        """Texts of block nodes in document order; tags without a rendering say nothing."""
        return [s for i in nodes if self.tag[i] in _RENDERINGS for s in _RENDERINGS[self.tag[i]](self, i) if s]

    def scope(self, paragraphs: Iterable[int]) -> tuple[str, list[dict]]:
        """T5: running text of paragraphs, and the spans of their links in it."""
        out: list[str] = []
        size = 0
        links: list[dict] = []

        def say(s: str) -> None:
            nonlocal size
            out.append(s)
            size += len(s)

        for p in paragraphs:
            pos, i = self.lo[p], p + 1
            while i < self.last[p]:
                link = self.tag[i] == "xref"
                if link or self.is_number(i):
                    say(self.text[pos : self.lo[i]])
                    start = size
                    say(self.raw(i) if link else self.head(i) + " ")
                    if link:
                        links.append({"href": self.get(i, "href"), "scope": self.get(i, "scope"), "start": start, "end": size})
                    pos, i = self.hi[i], self.last[i]
                else:
                    i += 1
            say(self.text[pos : self.hi[p]] + " ")
        return "".join(out), links

    def markers(self, at: int) -> dict[str, str]:
        """What the markers in a span say, by their name in brackets; the last of a name wins."""
        said = (re.search(r"\[(CaseNumber|Why)\](.*)", self.attr[i][""], re.S) for i in self.within(at, MARKER))
        return {m[1]: m[2] for m in said if m}


def _wrapped(tag: str, inner: str, more: str = "") -> str:
    return f"<{tag}{more}>{inner}</{tag}>"


_RENDERINGS: dict[str, Callable[[Nodes, int], list[str]]] = (
    dict.fromkeys(("p", "desc"), lambda n, i: [n.paragraph(i)])
    | dict.fromkeys(("ol", "ul"), Nodes._items)
    | dict.fromkeys(("table", "simpletable"), lambda n, i: [n.table(i)])
    | dict.fromkeys(("image", "fig"), Nodes._figure)
)


def parse(raw: str) -> Nodes | None:
    """The node table, or None for text that is not well-formed XML."""
    try:
        return Nodes(raw)
    except expat.ExpatError:
        return None
