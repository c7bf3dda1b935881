"""Main text of web pages by a minimum cut.

A page is parsed into text blocks. Each block gets a log-odds of being content from its length, links,
punctuation and the elements around it; the log-odds is the capacity of its edge to the content or to
the boilerplate terminal. Smoothness edges join neighbours in page order and siblings in the document
tree: labelling such a pair differently costs their capacity. A maximum flow saturates the cheapest cut,
and blocks still reachable from the content terminal are the content.

Elements and roles that are boilerplate by definition outweigh all smoothness edges of a block. So do
wrappers: containers with a boilerplate word in their class or id, and forms, whatever their length and
place. A paragraph of its own with a word that also styles text (``notice``, ``legal``) and being in or
out of an article are moderate costs that long text, neighbours and siblings can outvote. An article
inside boilerplate is boilerplate.

A wrapper that holds the page itself is free: a form around menus, articles or the like, and, where
wrappers leave next to nothing of a page, the one with the title or most text. Then only wrappers inside
it count.

Cases: null html is empty; a page without content blocks has an empty text; broken, truncated and very
long pages are read as far as they go, an unfinished tag at the end is markup, elements left open cost no
more than closed ones; equal rows are separate pages; an empty table gives an empty result. Scripts,
styles, comments, form controls and hidden elements are no blocks. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict, deque
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXTRACTED = "page_id long, url string, text string, n_blocks long, n_kept long"

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img".split()
)
SKIPPED = frozenset(
    "script style template noscript svg math iframe object canvas audio video select textarea button "
    "title option datalist map".split()
)
#: Elements and roles whose text is boilerplate, and words in classes and ids that say the same.
BOILERPLATE_TAGS = frozenset("nav footer aside menu dialog".split())
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split()
)
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
    "sidebar aside menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer header "
    "masthead topbar cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended trending "
    "comment comments commentlist disqus replies respond reply widget toolbar copyright legal disclaimer "
    "outbrain taboola skip thread threads msg messages discussion feedback reactions guestbook".split()
)
#: Words that also style a paragraph of the article; on such an element they are a moderate cost.
STYLING_WORDS = frozenset("notice notices alert notification legal copyright disclaimer related aside".split())
TEXT_TAGS = frozenset("p blockquote pre li dt dd td th figcaption h1 h2 h3 h4 h5 h6".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: No form that is only a form holds one of these.
STRUCTURE_TAGS = frozenset("article main nav header footer".split())
CONTENT_TAGS = frozenset(("article", "main"))
CONTENT_WORDS = frozenset("article content post entry story maincontent body text prose".split())
#: Before a word they say that something is beside the element, not in it.
BESIDE = frozenset("has with no without".split())
HEADER_WORDS = frozenset(("header", "masthead"))
#: Costs of class words and of the place of a block, against smoothness edges of at most 2.2.
CLASS_COST, INSIDE, OUTSIDE = 3.0, 2.0, 2.5
BY_DEFINITION = -8.0

_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_UNFINISHED = re.compile(r"<[A-Za-z/!?][^<>]*\Z")
_SENTENCE = re.compile(r"[.!?。][\"')\]]*(?:\s|\Z)")


@dataclass(slots=True)
class Element:
    tag: str
    boilerplate: bool
    content: bool
    hint: bool
    skipped: bool
    named: bool
    wrapper: int
    #: The last three block elements down to this one, and the tag of the last.
    path: tuple[int, ...]
    block_tag: str


@dataclass(slots=True)
class Block:
    text: str
    link_chars: int
    heading: bool
    boilerplate: bool
    content: bool
    hint: bool
    parents: tuple[int, ...]
    named: bool = False
    wrapper: int = 0
    title: bool = False


@dataclass(slots=True)
class Wrapper:
    """A named container or form; number 0 is the page. Parents have lower numbers."""

    parent: int
    form: bool
    structured: bool = False


class PageParser(HTMLParser):
    """Text blocks of a page in order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [Element("", False, False, False, False, False, 0, (0,), "")]
        #: Places in the stack: of each tag, of block elements, and of those that <p> doesn't count for.
        self.open: defaultdict[str, list[int]] = defaultdict(list)
        self.outer, self.containers = [0], [0]
        self.blocks: list[Block] = []
        self.wrappers = [Wrapper(0, False)]
        self.elements = 0
        self.parts: list[str] = []
        self.links = self.link_chars = 0

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE and tag != "br":
            self.end_block()
        if tag == "br":
            self.parts.append("\n")
        if tag in VOID:
            return
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
            self._close_implied(tag)
        top = self.stack[-1]
        self.elements += 1
        inline = tag in INLINE
        element = Element(
            tag, top.boilerplate, top.content, top.hint, top.skipped or tag in SKIPPED, top.named, top.wrapper,
            top.path if inline else (*top.path, self.elements)[-3:], top.block_tag if inline else tag,
        )
        if attrs or not inline:
            self._judge(element, dict(attrs))
        self._push(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _push(self, element):
        at, tag = len(self.stack), element.tag
        self.stack.append(element)
        self.open[tag].append(at)
        self.links += tag == "a"
        if tag not in INLINE:
            self.outer.append(at)
            if tag != "p":
                self.containers.append(at)

    def _pop_to(self, i):
        while len(self.stack) > i:
            tag = self.stack.pop().tag
            self.open[tag].pop()
            self.links -= tag == "a"
            if tag not in INLINE:
                self.outer.pop()
                if tag != "p":
                    self.containers.pop()

    def _close_implied(self, tag):
        """An open element of the same kind ends here, unless a container stands between."""
        open_tags = self.open[tag]
        if open_tags and open_tags[-1] >= self.containers[-1]:
            self._pop_to(open_tags[-1])

    def _judge(self, element, attrs):
        tag = element.tag
        if tag in ("html", "body"):
            return
        role = (attrs.get("role") or "").lower()
        negative, styling, hint = _names(attrs)
        if (
            "hidden" in attrs
            or (attrs.get("aria-hidden") or "").lower() == "true"
            or _HIDDEN.search(attrs.get("style") or "")
        ):
            element.skipped = True
        if tag in STRUCTURE_TAGS or role == "main":
            self.wrappers[element.wrapper].structured = True
        if tag in CONTENT_TAGS or role in ("main", "article"):
            # Comments are often articles by name; an article with a content word is one.
            if not negative or hint:
                element.content = not element.boilerplate
                return
        if (
            tag in BOILERPLATE_TAGS
            or role in BOILERPLATE_ROLES
            or tag == "header" and not element.content
        ):
            element.boilerplate = True
        elif tag == "form" or role == "form":
            self._wrap(element, True)
        elif negative and not hint:
            # A heading keeps its place in the article whatever its class says.
            if element.content and (tag in HEADINGS or tag == "header"):
                return
            if styling and tag in TEXT_TAGS:
                element.named = True
            else:
                self._wrap(element, False)
        elif hint and not negative:
            element.hint = True

    def _wrap(self, element, form):
        self.wrappers.append(Wrapper(element.wrapper, form))
        element.wrapper = len(self.wrappers) - 1

    def handle_endtag(self, tag):
        if tag not in INLINE and tag != "br":
            self.end_block()
        if tag == "br":
            self.parts.append("\n")
            return
        open_tags = self.open[tag]
        # An inline end tag doesn't reach beyond its block.
        if open_tags and (tag not in INLINE or open_tags[-1] > self.outer[-1]):
            self._pop_to(open_tags[-1])

    def handle_data(self, data):
        if not self.stack[-1].skipped:
            self.parts.append(data)
            if self.links:
                self.link_chars += len(data)

    def end_block(self):
        if not self.parts:
            return
        text = " ".join("".join(self.parts).split())
        if text:
            top = self.stack[-1]
            self.blocks.append(
                Block(
                    text, self.link_chars, top.block_tag in HEADINGS, top.boilerplate, top.content, top.hint,
                    top.path, top.named, top.wrapper, top.block_tag == "h1",
                )
            )
        self.parts, self.link_chars = [], 0


def _names(attrs: dict) -> tuple[bool, bool, bool]:
    """Whether a class or id names boilerplate, only with words that also style text, or names content."""
    negative = hint = False
    styling = True
    for key in ("class", "id"):
        for name in (attrs.get(key) or "").split():
            words = {w.lower(): None for w in _WORD.findall(name)}
            if words and next(iter(words)) in BESIDE:
                continue
            found = BOILERPLATE_WORDS.intersection(words)
            if found <= HEADER_WORDS and not CONTENT_WORDS.isdisjoint(words):
                # The header of an entry is part of it.
                hint = hint or not found
            elif found:
                negative = True
                styling = styling and found <= STYLING_WORDS
    return negative, styling, hint


def closed_wrappers(blocks: list[Block], wrappers: list[Wrapper]) -> list[bool]:
    """Whether each wrapper makes its blocks boilerplate; wrappers that hold the page itself don't."""
    n = len(wrappers)
    chars, title, positive, clear = [0] * n, [False] * n, [0] * n, [False] * n
    for b in blocks:
        if not b.boilerplate:
            w = b.wrapper
            chars[w] += len(b.text)
            title[w] = title[w] or b.title
            if log_odds(b, False) > 0:
                positive[w] += len(b.text)
                clear[w] = clear[w] or b.content or b.hint or b.title
    held, titled = chars.copy(), title.copy()
    structured = [w.structured for w in wrappers]
    children: list[list[int]] = [[] for _ in range(n)]
    for w in range(n - 1, 0, -1):
        parent = wrappers[w].parent
        children[parent].append(w)
        held[parent] += held[w]
        titled[parent] = titled[parent] or titled[w]
        structured[parent] = structured[parent] or structured[w]
    free = [w.form and s for w, s in zip(wrappers, structured, strict=True)]
    free[0] = True

    def closed():
        found = [False] * n
        for w in range(1, n):
            found[w] = found[wrappers[w].parent] or not free[w]
        return found

    shut = closed()
    left = sum(p for p, s in zip(positive, shut, strict=True) if not s)
    wrapped = sum(c for c, s in zip(chars, shut, strict=True) if s)
    if left:
        if any(c and not s for c, s in zip(clear, shut, strict=True)):
            return shut
        behind = any(t and s for t, s in zip(title, shut, strict=True))
        if left * (4 if behind else 20) >= wrapped:
            return shut
    # Down from the page, by title and text, to the first wrapper with text of its own.
    at = [w for w in range(1, n) if shut[w] and not shut[wrappers[w].parent]]
    while at:
        best = max(at, key=lambda w: (titled[w], held[w], -w))
        free[best] = True
        if positive[best]:
            break
        at = children[best]
    return closed()


def log_odds(block: Block, has_content_element: bool) -> float:
    """Positive for content; boilerplate by definition counts more than all smoothness edges together."""
    if block.boilerplate:
        return BY_DEFINITION
    n = len(block.text)
    z = 0.8 * math.log1p(n / 40) - 0.6
    z += 0.6 if _SENTENCE.search(block.text) else -0.4
    z -= 5.0 * min(1.0, block.link_chars / n)
    z += 0.8 * block.heading + 1.5 * block.hint
    if block.named:
        return max(BY_DEFINITION, min(z, CLASS_COST - 0.2) - CLASS_COST)
    if block.content:
        z = max(z, 0.0) + INSIDE
    elif has_content_element:
        z -= OUTSIDE
    return max(BY_DEFINITION, min(8.0, z))


def label(blocks: list[Block], odds: list[float]) -> list[bool]:
    """True for the blocks on the content side of the minimum cut."""
    n = len(blocks)
    if all(z > 0 for z in odds) or all(z <= 0 for z in odds):
        return [z > 0 for z in odds]  # one terminal has no edges: nothing to cut
    graph = FlowGraph(n + 2)
    source, sink = n, n + 1
    last_with_parent: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if odds[i] > 0:
            graph.add(source, i, odds[i], 0.0)
        else:
            graph.add(i, sink, -odds[i], 0.0)
        parent = block.parents[-2] if len(block.parents) > 1 else 0
        if i:
            shared = len(set(block.parents) & set(blocks[i - 1].parents))
            graph.add(i - 1, i, 0.2 + 0.2 * shared, 0.2 + 0.2 * shared)
        before = last_with_parent.get(parent)
        if before is not None and before != i - 1:
            graph.add(before, i, 0.3, 0.3)
        last_with_parent[parent] = i
    graph.saturate(source, sink)
    reached = graph.reachable(source)
    return [reached[i] for i in range(n)]


class FlowGraph:
    """Maximum flow by blocking flows over breadth-first levels."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[float] = []

    def add(self, a: int, b: int, forth: float, back: float) -> None:
        self.out[a].append(len(self.to))
        self.out[b].append(len(self.to) + 1)
        self.to += (b, a)
        self.room += (forth, back)

    def levels(self, source: int) -> list[int]:
        level = [-1] * len(self.out)
        level[source], queue = 0, deque([source])
        while queue:
            a = queue.popleft()
            for e in self.out[a]:
                b = self.to[e]
                if self.room[e] > 1e-9 and level[b] < 0:
                    level[b] = level[a] + 1
                    queue.append(b)
        return level

    def saturate(self, source: int, sink: int) -> None:
        while (level := self.levels(source))[sink] >= 0:
            at = [0] * len(self.out)
            path: list[int] = []
            node = source
            while True:
                if node == sink:
                    push = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= push
                        self.room[e ^ 1] += push
                    path, node = [], source
                    continue
                edges = self.out[node]
                while at[node] < len(edges):
                    e = edges[at[node]]
                    if self.room[e] > 1e-9 and level[self.to[e]] == level[node] + 1:
                        break
                    at[node] += 1
                if at[node] < len(edges):
                    path.append(edges[at[node]])
                    node = self.to[path[-1]]
                elif path:
                    node = self.to[path.pop() ^ 1]
                    at[node] += 1
                else:
                    break

    def reachable(self, source: int) -> list[bool]:
        return [x >= 0 for x in self.levels(source)]


def main_blocks(html: str) -> tuple[list[str], int]:
    """Content blocks of a page, and how many blocks it has."""
    parser = PageParser()
    parser.feed(_UNFINISHED.sub("", html))
    parser.close()
    parser.end_block()
    closed = closed_wrappers(parser.blocks, parser.wrappers)
    shut = [closed[b.wrapper] for b in parser.blocks]
    has_content = any(b.content and not (b.boilerplate or s) for b, s in zip(parser.blocks, shut, strict=True))
    odds = [
        BY_DEFINITION if s else log_odds(b, has_content) for b, s in zip(parser.blocks, shut, strict=True)
    ]
    kept = label(parser.blocks, odds)
    return [b.text for b, k in zip(parser.blocks, kept, strict=True) if k], len(odds)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            found = [main_blocks(h or "") for h in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array(["\n\n".join(b) for b, _ in found], pa.string()),
                    pa.array([n for _, n in found], pa.int64()),
                    pa.array([len(b) for b, _ in found], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_blocks", "n_kept"],
            )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_blocks, n_kept) of every page."""
    return pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    ).mapInArrow(_extract, EXTRACTED)
