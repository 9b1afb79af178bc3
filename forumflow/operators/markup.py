"""Small helpers that read one page inside a task: a lenient tree and extraction rules.

A rule is data: where to look, and what to take. Paths are the ElementTree subset of XPath;
``prefix`` adds the one test it lacks, an attribute that starts with a given text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from xml.etree import ElementTree as ET

# Fixed values of HTML: elements without an end tag, and start tags that end an open element.
VOID = frozenset(
    "area base br col embed hr img input link meta source track wbr".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr"
    " main nav ol p pre section table ul".split()
)
ENDS_SIBLING = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "option": ("option",),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
}
# An implied end tag does not reach beyond these.
CONTAINERS = frozenset("html body div article section ul ol dl table select blockquote".split())


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = ET.Element("document")
        self.open = [self.root]

    def _close(self, names: tuple[str, ...]) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.open[depth].tag
            if tag in names:
                del self.open[depth:]
                return
            if tag in CONTAINERS:
                return

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_PARAGRAPH:
            self._close(("p",))
        if tag in ENDS_SIBLING:
            self._close(ENDS_SIBLING[tag])
        element = ET.SubElement(self.open[-1], tag, {k: v or "" for k, v in reversed(attrs)})
        if tag not in VOID:
            self.open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                return

    def handle_data(self, data):
        parent = self.open[-1]
        if len(parent):
            parent[-1].tail = (parent[-1].tail or "") + data
        else:
            parent.text = (parent.text or "") + data

    def handle_comment(self, data):
        # A comment separates two text nodes, so it keeps a place in the tree.
        self.open[-1].append(ET.Comment())


def parse(html: str) -> ET.Element:
    """A tree of the page, however unclosed or misnested its tags are."""
    builder = _Tree()
    builder.feed(html)
    builder.close()
    return builder.root


def text_nodes(node: ET.Element) -> Iterator[tuple[ET.Element, str]]:
    """(owner, text) of all text nodes below a node, in document order."""
    stack = [(node, False)]
    while stack:
        element, after = stack.pop()
        if after:
            owner, child = element
            if child.tail:
                yield owner, child.tail
            continue
        if element.text:
            yield element, element.text
        for child in reversed(element):
            stack.append(((element, child), True))
            if isinstance(child.tag, str):
                stack.append((child, False))


@dataclass(frozen=True)
class Nodes:
    """Elements at a path; with ``prefix``, only those whose attribute starts with a text.

    ``then`` continues from each of them.
    """

    path: str
    prefix: tuple[str, str] | None = None
    then: str | None = None

    def find(self, base: ET.Element) -> list[ET.Element]:
        found = base.findall(self.path)
        if self.prefix:
            name, start = self.prefix
            found = [e for e in found if e.get(name, "").startswith(start)]
        if self.then:
            found = list(dict.fromkeys(e for f in found for e in f.findall(self.then)))
        if len(found) > 1:
            wanted = set(found)
            found = [e for e in base.iter() if e in wanted]
        return found

    def first_text(self, base: ET.Element) -> str | None:
        """The first text node that one of the elements holds directly."""
        found = self.find(base)
        owners = set(found)
        for node in found:
            for owner, text in text_nodes(node):
                if owner in owners:
                    return text
        return None

    def first_attribute(self, base: ET.Element, name: str) -> str | None:
        """The attribute of the first element that has it."""
        return next((e.get(name) for e in self.find(base) if e.get(name) is not None), None)

    def paragraph_texts(self, base: ET.Element) -> list[str | None]:
        """Of each element its first text node at any depth, None for an empty one."""
        return [next((text for _, text in text_nodes(e)), None) for e in self.find(base)]


def first_of(rules: tuple[Nodes, ...], base: ET.Element) -> str | None:
    """The text of the first rule that finds any."""
    return next((t for t in (r.first_text(base) for r in rules) if t is not None), None)
