"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text at block-level tags. A linear classifier on a block's surroundings, links
and words gives the cost of either label, which becomes its capacity to the source (content) or the sink
(boilerplate). Smoothness edges join each block with the one before it, with the one before it under the same
parent, and with the one before it in the same section; cutting one costs its weight. Maximum flow
finds the labelling of least cost: first, blocks whose own capacity outweighs all their edges
are settled and hand their edges' weight to their neighbours; augmenting paths settle the rest.

A name in a class, id, role or label speaks against an element if it is made up of words for boilerplate as a whole.
It is a cost, which long paragraphs without links or neighbours that are content can outweigh; nested names add up.
`main`, an `article` that isn't itself called so (as a comment may be), and elements that hold one bear none.

Raw text elements, comments, markup and attributes never become text. Character references are decoded, white
space inside a block becomes one space, and content blocks are joined by a line feed in page order; nothing else
is changed or cut. Unclosed tags end where the page ends. A null or empty page has an empty text; repeated
rows get equal results; an empty table gives an empty one. Only the named columns are read.
"""

from __future__ import annotations

import html
import re
from collections import deque
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from tidewire.llm.common import in_batches, texts

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?=(script|style|noscript|template|textarea|iframe|svg|math|title|select|object)(?:[\s/>]|\Z))"
    r"(?:(?:svg|math)(?:[^>\"']|\"[^\"]*\"|'[^']*')*/>|\1[^>]*(?:>.*?(?:</\1\s*>|\Z)|\Z))"
    r"|<(/?)([a-z][a-z0-9-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|</[^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
HINT = re.compile(r"(?<![\w-])(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
# Names of elements, and words in names of classes.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_SAME = frozenset("p li dt dd tr td th option".split())
SECTIONS = frozenset("article main section div body nav aside header footer form ul ol table blockquote".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog button fieldset header head".split())
CONTENT = frozenset("article main".split())
BAD_WORD = (
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu|sidebar|side|footer|header|masthead|cookies?|consent|"
    r"notice|alert|popup|modal|overlay|comments?|commentlist|disqus|respond|repl(?:y|ies)|share|sharing|social|related|recommend\w*|"
    r"newsletter|subscri\w*|signup|login|search|breadcrumbs?|pag(?:er|ination)|widget|toolbar|copyright|legal|navigation|"
    r"complementary|contentinfo|tags?|outbrain|taboola)"
)
# Words that leave a name what it is: `site-footer`, `left-sidebar`, `comment-body`, but not `has-sidebar`.
PLACE_WORD = (
    r"(?:site|page|main|global|primary|secondary|left|right|top|bottom|upper|lower|list|items?|area|bar|box|block|inner|outer|"
    r"wrap|wrapper|container|section|panel|form|links?|icons?|buttons?|posts?|articles?|stories|content|body|text|title|\d+)"
)
# Names of what readers say below an article; the article around it doesn't speak for it.
SAID_BY_READERS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|respond|repl(?:y|ies))(?:$|[\s_-])", re.IGNORECASE)
BAD_NAME = re.compile(rf"(?:{PLACE_WORD}[\s_-]+)*{BAD_WORD}(?:[\s_-]+(?:{BAD_WORD}|{PLACE_WORD}))*", re.IGNORECASE)
GOOD_NAME = re.compile(r"(?:^|[\s_-])(?:article|main|content|post|entry|story|body|text)(?:$|[\s_-])", re.IGNORECASE)

# The classifier: what speaks for content (above 0) and against it.
BIAS = -0.5
IN_BOILERPLATE = -9.0
BADLY_NAMED = -2.75
IN_CONTENT = 5.0
PARAGRAPH = 1.0
PER_WORD, MOST_WORDS = 0.05, 2.0
LINKED = -3.0
ENDS_SENTENCE = 0.5
# Smoothness edges.
NEXT_TO, SAME_PARENT, SAME_SECTION = 0.4, 0.6, 0.5


def said(attributes: str) -> tuple[bool, bool, bool]:
    """Whether an element's names speak against it, for it, and of readers. A label is one name, other attributes have one a word."""
    bad = good = readers = False
    for attribute, *value in HINT.findall(attributes):
        value = "".join(value)
        names = [value.strip()] if attribute.lower() == "aria-label" else value.split()
        for n in names:
            against = BAD_NAME.fullmatch(n) is not None
            bad, good = bad or against, good or not against and GOOD_NAME.search(n) is not None
            readers = readers or against and SAID_BY_READERS.search(n) is not None
    return bad, good, readers


@dataclass
class Element:
    name: str
    number: int
    section: int
    tags: float
    named: tuple[Element, ...] = ()
    holds_content: bool = False
    by_readers: bool = False

    @property
    def surroundings(self) -> float:
        return self.tags + BADLY_NAMED * sum(not e.holds_content for e in self.named)


@dataclass
class Block:
    text: str
    parent: int
    section: int
    element: Element
    paragraph: bool
    linked: int


@dataclass
class Page:
    """Cuts one page into blocks."""

    blocks: list[Block] = field(default_factory=list)
    stack: list[Element] = field(default_factory=lambda: [Element("", 0, 0, 0.0)])
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    in_link: int = 0
    elements: int = 0

    def read(self, page: str) -> list[Block]:
        at = 0
        for m in TOKEN.finditer(page):
            if m.start() > at:
                self._text(page[at : m.start()])
            at = m.end()
            name = m[3]
            if name:
                self._tag(name.lower(), bool(m[2]), m[4])
            elif m[1]:
                self.parts.append(" ")
        # A tag that the end of the page cuts off isn't text; TOKEN takes it.
        if at < len(page):
            self._text(page[at:])
        self._flush()
        return self.blocks

    def _text(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        self.parts.append(text)
        if self.in_link:
            self.linked += len(text)

    def _tag(self, name: str, closing: bool, attributes: str) -> None:
        if name == "a":
            self.in_link = 0 if closing else 1
        if name in INLINE:
            return
        if name in VOID:
            self.parts.append(" ")
            if name == "hr":
                self._flush()
            return
        self._flush()
        if closing:
            self._close(name)
            return
        if name in CLOSED_BY_SAME and self.stack[-1].name == name or self.stack[-1].name == "p":
            self.stack.pop()
        self.in_link = 0
        self.elements += 1
        above = self.stack[-1]
        bad, good, readers = said(attributes) if "=" in attributes else (False, False, False)
        by_readers = above.by_readers or readers and any(e.tags == IN_CONTENT for e in self.stack)
        content = not by_readers and (name == "main" or name == "article" and (good or not bad))
        tags, named = above.tags, above.named
        if by_readers and not above.by_readers:
            tags = BADLY_NAMED
        # An article's own header holds its headline.
        if name in BOILERPLATE and not (name == "header" and above.name == "article" and tags > 0):
            tags = IN_BOILERPLATE
        elif content and tags >= 0:
            tags, named = IN_CONTENT, ()
            for element in self.stack:
                element.holds_content = True
        elif good and not bad and tags == 0 and not named:
            tags = IN_CONTENT / 2
        section = self.elements if name in SECTIONS else above.section
        element = Element(name, self.elements, section, tags, named, by_readers=by_readers)
        if bad and not content and name not in ("html", "body"):
            element.named = (*named, element)
        self.stack.append(element)

    def _close(self, name: str) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].name == name:
                del self.stack[depth:]
                return
            if self.stack[depth].name in ("article", "main", "body", "table") and name in ("p", "li"):
                return

    def _flush(self) -> None:
        if not self.parts:
            return
        text = " ".join("".join(self.parts).split())
        if text:
            here = self.stack[-1]
            above = self.stack[-2].number if len(self.stack) > 1 else 0
            paragraph = here.name == "p" or here.name[:1] == "h" and here.name[1:].isdigit()
            self.blocks.append(Block(text, above, here.section, here, paragraph, min(self.linked, len(text))))
        self.parts.clear()
        self.linked = 0


def content_score(block: Block) -> float:
    """The classifier: cost of calling the block boilerplate less the cost of calling it content."""
    text = block.text
    return (
        BIAS
        + block.element.surroundings
        + PARAGRAPH * block.paragraph
        + min(MOST_WORDS, PER_WORD * (text.count(" ") + 1))
        + LINKED * block.linked / len(text)
        + ENDS_SENTENCE * (text[-1] in ".!?…。！？\"”»")
    )


def smoothness(blocks: list[Block]) -> list[dict[int, float]]:
    """For each block its neighbours and the weights of the edges to them."""
    edges: list[dict[int, float]] = [{} for _ in blocks]

    def join(a: int, b: int, weight: float) -> None:
        edges[a][b] = edges[b][a] = edges[a].get(b, 0.0) + weight

    by_parent: dict[int, int] = {}
    by_section: dict[int, int] = {}
    for n, block in enumerate(blocks):
        if n:
            join(n - 1, n, NEXT_TO)
        for seen, where, weight in ((by_parent, block.parent, SAME_PARENT), (by_section, block.section, SAME_SECTION)):
            if where in seen:
                join(seen[where], n, weight)
            seen[where] = n
    return edges


def minimum_cut(scores: list[float], edges: list[dict[int, float]]) -> list[bool]:
    """Which blocks stay on the source's side. `scores` and `edges` are used up."""
    label: list[bool | None] = [None] * len(scores)
    weight = [sum(e.values()) for e in edges]
    queue = deque(range(len(scores)))
    while queue:
        n = queue.popleft()
        if label[n] is not None or abs(scores[n]) < weight[n]:
            continue
        label[n] = scores[n] > 0
        for other, w in edges[n].items():
            if label[other] is None:
                scores[other] += w if label[n] else -w
                weight[other] -= w
                del edges[other][n]
                queue.append(other)
    rest = [n for n, side in enumerate(label) if side is None]
    if rest:
        reached = _reachable(rest, scores, edges)
        for n in rest:
            label[n] = n in reached
    return [bool(side) for side in label]


def _reachable(rest: list[int], scores: list[float], edges: list[dict[int, float]]) -> set[int]:
    """Blocks that the source still reaches after maximum flow: shortest paths level by level, all of a length at once."""
    source, sink = len(rest), len(rest) + 1
    place = {n: i for i, n in enumerate(rest)}
    out: list[list[int]] = [[] for _ in range(len(rest) + 2)]
    to: list[int] = []
    room: list[float] = []

    def join(a: int, b: int, forth: float, back: float) -> None:
        # An edge and the one back are neighbours in the lists.
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((forth, back))

    for n in rest:
        if scores[n] > 0:
            join(source, place[n], scores[n], 0.0)
        elif scores[n] < 0:
            join(place[n], sink, -scores[n], 0.0)
        for other, w in edges[n].items():
            if n < other:
                join(place[n], place[other], w, w)
    tiny = 1e-9
    while True:
        level = [-1] * len(out)
        level[source] = 0
        queue = deque([source])
        while queue:
            n = queue.popleft()
            for e in out[n]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[n] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return {n for n in rest if level[place[n]] >= 0}
        tried, path, here = [0] * len(out), [], source
        while True:
            if here == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                # Back to where the first edge of the path is full.
                full = next(i for i, e in enumerate(path) if room[e] <= tiny)
                here = to[path[full] ^ 1]
                del path[full:]
                continue
            edge = next_edge(out[here], tried, here, room, level, to, tiny)
            if edge is not None:
                path.append(edge)
                here = to[edge]
            elif here == source:
                break
            else:
                level[here] = -1
                here = to[path.pop() ^ 1]


def next_edge(own: list[int], tried: list[int], here: int, room: list[float], level: list[int], to: list[int], tiny: float) -> int | None:
    """The next edge down a level with room left; earlier ones are never looked at again."""
    while tried[here] < len(own):
        e = own[tried[here]]
        if room[e] > tiny and level[to[e]] == level[here] + 1:
            return e
        tried[here] += 1
    return None


def main_text(page: str) -> str:
    blocks = Page().read(page)
    content = minimum_cut([content_score(b) for b in blocks], smoothness(blocks))
    return "\n".join(b.text for b, stays in zip(blocks, content, strict=True) if stays)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page: its key and address, `text` and `n_chars`."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [main_text(p) for p in texts(batch, page)]
        return pa.RecordBatch.from_arrays(
            [batch.column(key), batch.column(url), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
            [key, url, "text", "n_chars"],
        )

    kinds = [f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in (key, url)]
    return in_batches(pages.select(key, url, page), work, f"{', '.join(kinds)}, text string, n_chars bigint")
