"""Main text of pages by a tree-structured graphical model.

Every block of a page's tree, and every inline element with a telling class or id, is a binary
variable: does its subtree hold content? A node emits what can be seen of it (element, words in its
class, id and role, length of its text, share of links); a parent and a child are tied by a
potential. On a tree, messages passed once upward and once downward give exact marginals, and text
counts as content where the marginal of its node reaches 1/2.

Potentials are smoothed counts over labelled pages. The given pages carry no labels, so the training
pages are made by a generator with known roles, ``TRAINING_PAGES`` of them (a documented bound of
the model); their words are drawn anew, only layout matters. Counting is a grouped aggregation.

Defined results: null and empty html give an empty text; html that does not parse as markup is
text; equal rows are results of their own; no pages give no rows; other columns are ignored. Texts
are never cut.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumflow.llm.staging import batches_of
from forumflow.operators.markup import parse

TRAINING_PAGES = 2_000
_BATCH = 4 << 20
# Elements of HTML that do not begin a block, and elements without text of their own.
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
SILENT = frozenset(
    "button iframe input noscript object option script select style svg template textarea title"
    .split()
)
KNOWN = frozenset(
    "address article aside blockquote body caption dd details div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup html li main nav ol p pre section table tbody td"
    " th thead tr ul".split()
)
# Words in classes, ids and roles, by what they say. A word counts as a whole, or
# as a beginning where it ends with a hyphen here.
HINTS = {
    "advert": "ad ads adv advert- adsense adslot banner promo- sponsor- commercial",
    "menu": "nav navbar navigation- menu- breadcrumb- pagination pager toc tabs toolbar",
    "page": "header masthead footer- copyright legal contentinfo topbar bottom site-",
    "side": "sidebar- aside side widget- complementary related recommend- popular trending rail",
    "notice": "notice- cookie- consent gdpr alert- warning disclaimer popup modal overlay- message",
    "form": "form- search- login signup subscribe- newsletter- register contact",
    "reader": "comment- comments- reply- replies discussion respond disqus feedback review-",
    "share": "share- social- follow like likes tags tag meta byline author- rating print",
    "hidden": "hidden- invisible sr skip visually",
    "content": "article- content- main post- entry- story- text body prose read",
}


def _patterns() -> dict[str, re.Pattern]:
    out = {}
    for family, words in HINTS.items():
        parts = [re.escape(w[:-1]) + "[a-z0-9]*" if w.endswith("-") else re.escape(w) for w in words.split()]
        out[family] = re.compile("|".join(f"(?:{p})" for p in parts))
    return out


_PATTERNS = _patterns()
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def hint(attributes: dict[str, str]) -> str:
    """The family that the words of class, id and role speak for; content only if no other."""
    if "hidden" in attributes or "display:none" in attributes.get("style", "").replace(" ", ""):
        return "hidden"
    named = " ".join(attributes.get(a, "") for a in ("class", "id", "role"))
    if not named.strip():
        return "none"
    found = "none"
    for word in _SPLIT.split(_CAMEL.sub(" ", named).lower()):
        for family, pattern in _PATTERNS.items():
            if pattern.fullmatch(word):
                if family != "content":
                    return family
                found = family
    return found


@dataclass
class Page:
    """Nodes of a page's graph in document order; a parent stands before its children."""

    parent: list[int]
    tag: list[str]
    hint: list[str]
    size: list[int]  # characters of the subtree
    linked: list[int]  # those of them within links
    label: list[int]  # data-label, where a training page has one
    within: list[bool]  # below an article
    place: list[str]  # where it lies against the page's article, or its main element
    text: list[tuple[int, str]]  # (node, text), or (-1, "") where a block begins or ends

    def find_places(self) -> None:
        """``in`` the article, ``over`` it, ``out`` of it, or ``none`` if the page has none."""
        anchors = [i for i, t in enumerate(self.tag) if t == "article"]
        anchors = anchors or [i for i, t in enumerate(self.tag) if t == "main"]
        self.place = ["out" if anchors else "none"] * len(self.tag)
        for i in anchors:
            self.place[i] = "in"
        for i in range(1, len(self.tag)):
            if self.place[self.parent[i]] == "in":
                self.place[i] = "in"
        for i in anchors:
            while (i := self.parent[i]) >= 0 and self.place[i] == "out":
                self.place[i] = "over"

    def features(self, i: int) -> tuple[str, ...]:
        size = self.size[i]
        length = 0 if not size else 1 + sum(size >= limit for limit in (20, 60, 150, 500))
        share = self.linked[i] / size if size else 0
        links = 0 if not self.linked[i] else 1 + sum(share >= limit for limit in (0.15, 0.5, 0.85))
        tag = self.tag[i] if self.tag[i] in KNOWN else "other"
        if self.tag[i] in INLINE:
            tag = "inline"
        if tag == "header" and self.within[i]:
            tag = "header of an article"
        return f"tag {tag}", f"hint {self.hint[i]}", f"size {length}", f"links {links}", f"place {self.place[i]}"


def read_page(html: str) -> Page:
    """The graph of a page."""
    try:
        root = parse(html)
    except AssertionError:  # an unknown marked section; take it as text
        root = parse(html.replace("<![", "&lt;!["))
    page = Page([-1], ["html"], ["none"], [0], [0], [1], [False], [], [])
    # Entries are (element, node, in a link) on the way in and (node,) on the way out.
    stack: list = [(root, 0, False, True)]

    def say(node: int, text: str | None, linked: bool) -> None:
        if text:
            page.text.append((node, text))
            n = len("".join(text.split()))
            page.size[node] += n
            page.linked[node] += n * linked

    while stack:
        element, node, linked, entering = stack.pop()
        if not entering:
            if element is None:
                page.text.append((-1, ""))
            else:
                say(node, element.tail, linked)
            continue
        tag = element.tag
        inner, inside = node, linked or tag == "a"
        block = tag not in INLINE
        if not isinstance(tag, str) or tag in SILENT:
            continue
        if tag != "document":
            attributes = dict(element.attrib)
            family = hint(attributes)
            if block or family not in ("none", "content"):
                inner = len(page.parent)
                page.parent.append(node)
                page.tag.append(tag)
                page.hint.append(family)
                page.size.append(0)
                page.linked.append(0)
                page.label.append(int(attributes.get("data-label", -1)))
                page.within.append(page.within[node] or page.tag[node] == "article")
        if block:
            page.text.append((-1, ""))
            stack.append((None, node, linked, False))
        if tag == "br":
            page.text.append((node, " "))
        say(inner, element.text, inside)
        for child in reversed(element):
            stack.append((child, inner, inside, False))
            stack.append((child, inner, inside, True))
    for i in range(len(page.parent) - 1, 0, -1):
        page.size[page.parent[i]] += page.size[i]
        page.linked[page.parent[i]] += page.linked[i]
    page.find_places()
    return page


@dataclass(frozen=True)
class Model:
    """Log potentials: of a feature and a label, and of a parent's label and a child's."""

    emission: dict[str, tuple[float, float]]
    unseen: tuple[float, float]
    edge: tuple[tuple[float, float], tuple[float, float]]


def _sum(a: float, b: float) -> float:
    high = a if a > b else b
    return high + math.log1p(math.exp((a if a < b else b) - high))


def marginals(page: Page, model: Model) -> list[float]:
    """Probability of content for each node, by messages up and down the tree."""
    n = len(page.parent)
    own0, own1 = [0.0] * n, [0.0] * n
    for i in range(1, n):
        for f in page.features(i):
            e = model.emission.get(f, model.unseen)
            own0[i] += e[0]
            own1[i] += e[1]
    (e00, e01), (e10, e11) = model.edge
    up0, up1 = [0.0] * n, [0.0] * n
    for i in range(n - 1, 0, -1):  # own0 and own1 already hold the children's messages
        up0[i] = _sum(e00 + own0[i], e01 + own1[i])
        up1[i] = _sum(e10 + own0[i], e11 + own1[i])
        own0[page.parent[i]] += up0[i]
        own1[page.parent[i]] += up1[i]
    out = [1.0] * n
    # The document itself holds content; below it, a belief is the message down times all from below.
    belief0, belief1 = [-1e9] * n, [0.0] * n
    for i in range(1, n):
        p = page.parent[i]
        rest0, rest1 = belief0[p] - up0[i], belief1[p] - up1[i]  # the parent without this child
        down0 = _sum(rest0 + e00, rest1 + e10)
        down1 = _sum(rest0 + e01, rest1 + e11)
        b0, b1 = own0[i] + down0, own1[i] + down1
        high = b0 if b0 > b1 else b1
        total = _sum(b0, b1)
        belief0[i], belief1[i] = b0 - high, b1 - high
        out[i] = math.exp(b1 - total)
    return out


def main_text(html: str | None, model: Model) -> str:
    """Blocks of content, one per line, white space within them as single spaces."""
    if not html:
        return ""
    page = read_page(html)
    content = marginals(page, model)
    blocks: list[str] = []
    parts: list[str] = []
    for node, text in [*page.text, (-1, "")]:
        if node < 0:
            block = " ".join("".join(parts).split())
            if block:
                blocks.append(block)
            parts = []
        elif content[node] >= 0.5:
            parts.append(text)
    return "\n".join(blocks)


# Labelled pages.


def _words(r: random.Random, low: int, high: int) -> str:
    syllables = "an be do er in ka lo mi ne or re sa ti un ve".split()
    words = ["".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(r.randint(low, high))]
    return " ".join(words).capitalize() + r.choice([".", ".", "", "!"])


def labelled_page(seed: int) -> str:
    """A made-up page whose elements say whether they hold content."""
    r = random.Random(seed)

    def el(tag: str, label: int, body: str, family: str | None = None, chance: float = 0.8) -> str:
        named = ""
        if family and r.random() < chance:
            word = r.choice(HINTS[family].split()).rstrip("-")
            named = f' {r.choice(["class", "id"])}="{word}"'
        return f'<{tag} data-label="{label}"{named}>{body}</{tag}>'

    def link(low: int = 1, high: int = 4) -> str:
        return f'<a href="/x">{_words(r, low, high)}</a>'

    def links(tag: str, family: str, chance: float = 0.8) -> str:
        items = "".join(el("li", 0, link()) for _ in range(r.randint(2, 8)))
        body = el("ul", 0, items) if r.random() < 0.8 else " ".join(link() for _ in range(4))
        return el(tag, 0, body, family, chance)

    def small(family: str) -> str:
        tag = r.choice(["div", "div", "section", "aside", "p"])
        body = _words(r, 2, 25) if tag == "p" else r.choice([_words(r, 2, 25), el("p", 0, _words(r, 2, 40))])
        return el(tag, 0, body, family, 1.0)

    def comments() -> str:
        one = lambda: el("div", 0, el("p", 0, _words(r, 3, 70)), "reader", 0.9)
        tag = r.choice(["div", "section", "aside", "ol"])
        return el(tag, 0, el(r.choice(["h2", "h3", "h4"]), 0, "Comments") + "".join(one() for _ in range(r.randint(1, 5))), "reader", 1.0)

    def form() -> str:
        return el("form", 0, _words(r, 1, 8) + el("p", 0, "<label>Name</label>" + _words(r, 1, 6)), "form", 0.5)

    def paragraph() -> str:
        body = _words(r, 1 if r.random() < 0.15 else 6, 120)
        if r.random() < 0.2:
            body += f" {link(1, 6)} {_words(r, 2, 30)}"
        if r.random() < 0.05:
            body += f' <span class="ad" data-label="0">{_words(r, 1, 5)}</span>'
        return el("p", 1, body)

    def story() -> str:
        wrap = r.choice(["article", "article", "main", "div", "section"])
        parts = [el("h1", 1, _words(r, 2, 14))]
        if wrap == "article" and r.random() < 0.3:
            parts = [el("header", 1, parts[0])]
        for _ in range(r.randint(1, 14)):
            x = r.random()
            if x < 0.74:
                parts.append(paragraph())
            elif x < 0.8:
                parts.append(el(r.choice(["h2", "h3", "h4"]), 1, _words(r, 1, 6)))
            elif x < 0.9:
                items = "".join(el("li", 1, _words(r, 2, 25)) for _ in range(r.randint(2, 6)))
                parts.append(el(r.choice(["ul", "ol"]), 1, items))
            elif x < 0.93:
                parts.append(el("blockquote", 1, paragraph()))
            elif x < 0.95:
                rows = "".join(el("tr", 1, el("td", 1, _words(r, 1, 5)) * 2) for _ in range(3))
                parts.append(el("table", 1, rows))
            elif x < 0.96:
                parts.append(el("pre", 1, _words(r, 5, 40)))
            else:
                parts.append(small(r.choice(["advert", "notice", "share", "side", "form"])))
        if r.random() < 0.2:
            parts.append(comments())
        body = "".join(parts)
        return el(wrap, 1, body, "content", 0.6 if wrap != "div" else 1.0)

    top = [links("nav", "menu", 0.4) if r.random() < 0.8 else links("div", "menu", 1.0)]
    if r.random() < 0.8:
        name = el(r.choice(["div", "h1", "p"]), 0, _words(r, 1, 5))
        top.append(el("header", 0, name + links("nav", "menu", 0.3), "page", 0.5))
    if r.random() < 0.7:
        top.append(small(r.choice(["advert", "notice", "page", "hidden"])))
    bottom = [el("footer", 0, r.choice([_words(r, 2, 30), el("p", 0, _words(r, 2, 20))]), "page", 0.4)]
    if r.random() < 0.5:
        bottom.insert(0, el(r.choice(["aside", "div"]), 0, el(r.choice(["h2", "h3", "h4"]), 0, _words(r, 1, 3)) + links("div", "side", 0.4), "side", 1.0))
    if r.random() < 0.3:
        bottom.insert(0, comments())
    if r.random() < 0.3:
        bottom.insert(0, form())
    if r.random() < 0.3:
        bottom.insert(0, small(r.choice(["share", "side", "advert", "notice"])))
    middle = story()
    if r.random() < 0.4:
        middle = el("div", 1, middle, "page" if r.random() < 0.1 else None)
    if r.random() < 0.5:
        r.shuffle(top)
    return f'<html data-label="1"><body data-label="1">{"".join(top)}{middle}{"".join(bottom)}</body></html>'


def train(spark: SparkSession, pages: int = TRAINING_PAGES) -> Model:
    """Potentials from counts over labelled pages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for seed in batch.column("id").to_pylist():
                page = read_page(labelled_page(seed))
                for i in range(1, len(page.parent)):
                    label = page.label[i] if page.label[i] >= 0 else page.label[page.parent[i]]
                    page.label[i] = label
                    seen.update((f, label) for f in page.features(i))
                    seen[f"parent {page.label[page.parent[i]]}", label] += 1
            keys = list(seen)
            yield pa.record_batch(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.int32()),
                    pa.array([seen[k] for k in keys], pa.int64()),
                ],
                ["what", "label", "n"],
            )

    counts = spark.range(pages).mapInArrow(count, "what string, label int, n bigint")
    rows = counts.groupBy("what", "label").agg(F.sum("n").alias("n")).collect()  # a few hundred
    n: dict[str, list[float]] = {}
    for r in rows:
        n.setdefault(r["what"], [0.0, 0.0])[r["label"]] = float(r["n"])
    parents = [n.pop("parent 0", [1.0, 0.0]), n.pop("parent 1", [1.0, 1.0])]
    edge = tuple(
        tuple(math.log((p[y] + 0.01) / (p[0] + p[1] + 0.02)) for y in (0, 1)) for p in parents
    )
    total = [sum(v[y] for k, v in n.items() if k.startswith("tag ")) for y in (0, 1)]
    emission = {
        k: tuple(math.log((v[y] + 0.5) / (total[y] + 10)) for y in (0, 1)) for k, v in n.items()
    }
    unseen = tuple(math.log(0.5 / (t + 10)) for t in total)
    # A feature never seen says nothing: both labels are given the same value.
    return Model(emission, (min(unseen), min(unseen)), edge)


def extract_pages(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "html", _BATCH):
            texts = [main_text(h.as_py(), model) for h in batch.column("html")]
            yield pa.record_batch(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return pages.select("page_id", "url", "html").mapInArrow(
        read, f"{kinds}, text string, n_chars bigint"
    )
