"""The main text of web pages by minimum cut.

A page is cut into blocks of text at its block elements. A linear classifier over
what stands around a block and over its text gives each block a cost for being
left out or kept; these are the capacities to the two terminals. Blocks that
follow each other, and blocks and the elements that hold them, are joined by
smoothness edges, weaker the more levels of the document lie between. The least
cut of that graph parts the main text from the rest, so that a short line among
paragraphs stays with them and a sentence in a menu goes with the menu. Pages do
not depend on each other: nothing is shuffled, and a task holds one at a time.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_arrow, text_slices
from millrace.llm.mincut import source_side

SLICE_BYTES = 1_000_000

# Fixed values of the HTML language: what ends a block, what has no end tag, what
# holds no text of the page, and what an opening tag closes.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr "
    "html legend li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
VOID = frozenset(
    "area base br col embed frame hr img input link meta param source track wbr".split()
)
SILENT = frozenset(
    "script style noscript template svg math title textarea select button iframe object canvas "
    "audio video noframes head datalist".split()
)
RAW = frozenset("script style textarea title iframe noframes".split())
CLOSES = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "body": frozenset(["head"]),
}
LISTS = frozenset("ul ol menu dir dl table body html".split())

# Fixed values of the classifier: names of classes, ids and roles.
LEFT_OUT_TAGS = frozenset("nav footer aside dialog menu search".split())
LEFT_OUT = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs "
    "complementary consent contentinfo cookie cookies copyright disclaimer footer gdpr legal "
    "login menu modal nav navbar navigation newsletter notice notices notification overlay pager "
    "pagination pagenav popup promo promotion promotions recommended related rail search share "
    "sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar "
    "widget alert dialog".split()
)
HEADERS = frozenset("header masthead".split())
COMMENTS = frozenset(
    "comment comments commentlist comentarios commentaires discussion disqus kommentare replies "
    "reply respond responses".split()
)
KEPT_TAGS = frozenset(["article", "main"])
KEPT = frozenset("article articlebody content entry hentry main maincontent post story".split())


@dataclass(frozen=True)
class Weights:
    """The classifier and the smoothness. Positive values speak for main text."""

    start: float = -1.0
    words: float = 2.5
    enough_words: int = 30
    sentence: float = 1.0
    links: float = -4.0
    heading: float = 1.0
    item: float = -0.5
    kept: float = 6.0
    left_out: float = -6.0
    never: float = -8.0
    form: float = -2.5
    header: float = -4.0
    outside: float = -3.0
    neighbours: float = 1.2
    holder: float = 0.8


DEFAULT = Weights()

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<more>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<more2>[^>]*+)(?:>|\Z)",
    re.DOTALL,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)
_HIDDEN = re.compile(
    r"(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none|visibility\s*:\s*hidden",
    re.IGNORECASE,
)
_WORDS_OF_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_ENDS_SENTENCE = re.compile(r"[.!?…。！？][\"'”’»)\]]*$")
_MARKED = re.compile("class|id|role|hidden|style", re.IGNORECASE)


@lru_cache(maxsize=4096)
def evidence(tag: str, more: str) -> str:
    """What an element says of the text in it; nothing for most."""
    if tag in LEFT_OUT_TAGS:
        return "never"
    words: set[str] = set()
    # Classes of the whole page say what it has, not what it is.
    if tag not in ("html", "body") and _MARKED.search(more):
        if _HIDDEN.search(more):
            return "never"
        for groups in _NAMES.findall(more):
            name = "".join(groups)
            words.update(word.lower() for word in _WORDS_OF_NAME.findall(name))
            words.update(part.lower() for part in re.split(r"[\W_]+", name))
    if words & COMMENTS:
        return "never"
    if words & LEFT_OUT:
        return "left_out"
    if tag in KEPT_TAGS or words & KEPT:
        return "kept"
    if tag == "header" or words & HEADERS:
        return "header"
    return tag if tag == "form" else ""


def region(above: str, says: str) -> str:
    """What an element and those around it say together.

    Menus, footers, sidebars, comments and hidden elements rule from any distance;
    otherwise the innermost that says something, but the head of an article
    belongs to it and a form in an article does not.
    """
    if "never" in (above, says):
        return "never"
    if above == "kept" and says == "header":
        return "kept"
    if above == "kept" and says == "form":
        return "left_out"
    return says or above


@dataclass
class Element:
    tag: str
    region: str
    number: int
    parent: Element | None
    depth: int
    links: bool
    silent: bool


@dataclass
class Block:
    """Text between two block boundaries and the element that holds it."""

    holder: Element
    text: str
    linked: int


@dataclass
class Reader:
    """Blocks of one page. Tags may be missing, unclosed or in any order."""

    blocks: list[Block] = field(default_factory=list)
    elements: int = 0
    parts: list[str] = field(default_factory=list)
    begun: bool = False
    linked: int = 0

    def read(self, page: str) -> list[Block]:
        now = holder = Element("", "", 0, None, 0, False, False)
        at = 0
        raw = ""
        for found in _TAG.finditer(page):
            if found.start() < at:
                continue
            name = (found["name"] or found["name2"] or "").lower()
            ends = bool(found["end"] or found["end2"])
            if raw and not (ends and name == raw):
                continue
            if found.start() > at:
                holder = self._add(page[at : found.start()], now, holder)
            at = found.end()
            raw = ""
            if not name:
                continue
            if name in BLOCKS:
                self._end_block(holder)
            elif name == "br":
                self.parts.append(" ")
            if ends:
                now = self._close(now, name)
            elif name not in VOID:
                now = self._open(now, name, found["more"] or found["more2"] or "")
                if name in RAW:
                    raw = name
        if not raw and at < len(page):
            holder = self._add(page[at:], now, holder)
        self._end_block(holder)
        return self.blocks

    def _add(self, text: str, now: Element, holder: Element) -> Element:
        if now.silent:
            return holder
        text = html.unescape(text)
        self.parts.append(text)
        if now.links:
            self.linked += len(text.split())
        if self.begun or not text.strip():
            return holder
        self.begun = True
        return now

    def _end_block(self, holder: Element) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(holder, text, self.linked))
        self.parts, self.begun, self.linked = [], False, 0

    def _open(self, now: Element, name: str, more: str) -> Element:
        if name in BLOCKS:
            # A paragraph ends where the next block begins.
            above = now
            while above.parent and above.tag not in BLOCKS:
                above = above.parent
            if above.tag == "p":
                now = above.parent
        closes = CLOSES.get(name)
        if closes:
            above = now
            while above.parent and above.tag not in LISTS:
                if above.tag in closes:
                    now = above.parent
                above = above.parent
        self.elements += 1
        return Element(
            name,
            region(now.region, evidence(name, more)),
            self.elements,
            now,
            now.depth + 1,
            now.links or name == "a",
            now.silent or name in SILENT,
        )

    def _close(self, now: Element, name: str) -> Element:
        above = now
        while above.parent and above.tag != name:
            # An inline end tag does not close the block around it.
            if name not in BLOCKS and above.tag in BLOCKS:
                return now
            above = above.parent
        return above.parent or now


def cost(block: Block, marked: bool, weights: Weights = DEFAULT) -> float:
    """What leaving the block out costs; keeping it costs the negative.

    ``marked`` tells that the page says where its text is.
    """
    words = len(block.text.split())
    total = weights.start + weights.words * min(words, weights.enough_words) / weights.enough_words
    total += weights.links * min(block.linked / max(words, 1), 1.0)
    if _ENDS_SENTENCE.search(block.text):
        total += weights.sentence
    tag, said = block.holder.tag, block.holder.region
    if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        total += weights.heading
    elif tag == "li":
        total += weights.item
    if said:
        return total + getattr(weights, said)
    return total + (weights.outside if marked else 0.0)


def costs(blocks: list[Block], weights: Weights = DEFAULT) -> list[float]:
    marked = any(block.holder.region == "kept" for block in blocks)
    return [cost(block, marked, weights) for block in blocks]


def _steps(a: Element, b: Element) -> int:
    """Levels between two elements by way of what holds both."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def labels(blocks: list[Block], weights: Weights = DEFAULT) -> list[bool]:
    """Which blocks are main text, by the least cut."""
    edges = []
    for i in range(len(blocks) - 1):
        steps = _steps(blocks[i].holder, blocks[i + 1].holder)
        edges.append((i, i + 1, weights.neighbours / (1 + steps)))
    # Elements without text of their own are nodes without a cost.
    nodes: dict[int, int] = {}
    for i, block in enumerate(blocks):
        weight, lower, around = weights.holder, i, block.holder.parent
        while around:
            known = around.number in nodes
            node = nodes.setdefault(around.number, len(blocks) + len(nodes))
            edges.append((lower, node, weight))
            if known:
                break
            lower, around, weight = node, around.parent, weight / 2
    return source_side(costs(blocks, weights) + [0.0] * len(nodes), edges)[: len(blocks)]


def main_blocks(page: str, weights: Weights = DEFAULT) -> list[str]:
    blocks = Reader().read(page)
    return [block.text for block, kept in zip(blocks, labels(blocks, weights)) if kept]


def labelled_blocks(pages: DataFrame, weights: Weights = DEFAULT, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Every block of every page in order, with its cost and its label."""
    schema = "page_id bigint, block int, text string, cost double, main boolean"
    narrow = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(html_col).alias("page"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "page", SLICE_BYTES):
            rows = []
            for page_id, text in zip(batch.column("page_id").to_pylist(), texts.to_pylist()):
                blocks = Reader().read(text)
                rows += [
                    (page_id, i, block.text, paid, kept)
                    for i, (block, paid, kept) in enumerate(
                        zip(blocks, costs(blocks, weights), labels(blocks, weights))
                    )
                ]
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds)],
                names=["page_id", "block", "text", "cost", "main"],
            )

    return map_arrow(narrow, label, schema)


def main_text(
    pages: DataFrame,
    weights: Weights = DEFAULT,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """page_id, url, the main text of the page, and its length in code points.

    Character references are decoded, white space in a block is one space, blocks
    are joined by a line feed. A null page, an empty one and one without main text
    give the empty text; null ids and urls and repeated rows come back as they are;
    long pages are read whole; other columns are ignored; an empty table gives no
    rows.
    """
    schema = "page_id bigint, url string, text string, n_chars bigint"
    narrow = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("page")
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "page", SLICE_BYTES):
            found = ["\n".join(main_blocks(text, weights)) for text in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(found, pa.string()),
                    pa.array([len(text) for text in found], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return map_arrow(narrow, extract, schema)
