"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is parsed into leaf blocks, the runs of text between the borders of
block elements.  A block's features are its ancestors' element names and the
words of their class and id attributes, and the shape of its text (length, links,
punctuation).  The chain is trained on labelled pages (``html_pages``) and decoded
by Viterbi; blocks labelled main are the text.

Contents of scripts, styles, templates and comments are no text.  Character
references are decoded, white space inside a block becomes one space, blocks are
trimmed and joined by one space in page order.  Null and empty pages give the
empty text.  Pages are taken whole, however long or badly nested.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm import crf
from lexloom.llm.html_pages import MAIN_MARK, REST_MARK, marked_page
from lexloom.llm.runtime import slices, text_or_empty

#: Pages the extractor is trained on, and uses of a feature from which it counts.
TRAINING_PAGES, LEAST_USES = 1200, 4
#: Elements that are remembered from page to page, and bytes of pages that are parsed at a time.
MOST_NODES, BATCH_BYTES = 20_000, 8 << 20

#: Elements whose text is no text, elements without content, and elements that do not end a block.
_SILENT = {"script", "style", "template"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
#: What an element's start closes if it is open.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_KEEPS_OPEN = {"ul", "ol", "dl", "table", "article", "section", "div", "main", "aside", "body"}
_TELLING = {f"in:{x}" for x in ("nav", "header", "footer", "aside", "form", "article", "main")}
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


class Node:
    """An open element: its name, the words of its attributes, and the element that it is in.

    Nodes of equal ancestry are one object, so what an extractor finds out about one
    is found out once, and a page however deep costs one node for each element.
    """

    __slots__ = ("tag", "names", "above", "below", "known", "weight")

    def __init__(self, tag: str = "", names: tuple[str, ...] = (), above: Node | None = None):
        self.tag, self.names, self.above = tag, names, above
        self.below: dict[tuple, Node] = {}
        self.known: frozenset[int] | None = None
        self.weight: np.ndarray | None = None

    def inner(self, tag: str, names: tuple[str, ...]) -> Node:
        found = self.below.get((tag, names))
        if found is None:
            found = self.below[tag, names] = Node(tag, names, self)
        return found

    def path(self) -> Iterator[Node]:
        """This element and those around it, innermost first."""
        node = self
        while node.above is not None:
            yield node
            node = node.above


@dataclass
class Block:
    """A leaf block: its text, the element that it stands in, characters within links, and whether its page is plain."""

    text: str
    node: Node
    linked: int
    plain: bool = False


class _Parser(HTMLParser):
    def __init__(self, root: Node) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[Node] = [root]
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = self.links = 0
        self.node: Node | None = None
        self.silent: str | None = None
        # How many elements of a name are open: at all, since the last one that keeps others open, and since the last block element.
        self.open: Counter = Counter()
        self.kept: list[Counter] = [Counter()]
        self.solid: list[Counter] = [Counter()]

    def _end_block(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", "".join(self.parts)).strip()
            if text:
                self.blocks.append(Block(text, self.node or self.stack[-1], self.linked))
            self.parts = []
        self.linked, self.node = 0, None

    def _push(self, tag: str, names: tuple[str, ...]) -> None:
        self.stack.append(self.stack[-1].inner(tag, names))
        self.links += tag == "a"
        self.open[tag] += 1
        self.kept[-1][tag] += 1
        self.solid[-1][tag] += 1
        if tag in _KEEPS_OPEN:
            self.kept.append(Counter())
        if tag not in _INLINE:
            self.solid.append(Counter())

    def _pop(self, tag: str) -> None:
        """Close the innermost open ``tag`` and all within it."""
        done = False
        while not done:
            last = self.stack.pop().tag
            done = last == tag
            if last not in _INLINE:
                self.solid.pop()
            if last in _KEEPS_OPEN:
                self.kept.pop()
            self.links -= last == "a"
            self.open[last] -= 1
            self.kept[-1][last] -= 1
            self.solid[-1][last] -= 1

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.silent:
            return
        if tag in _SILENT:
            self.silent = tag
            return
        if tag == "br":
            self.parts.append(" ")
            return
        names: tuple[str, ...] = ()
        for k, v in attrs:
            if k in ("class", "id", "role") and v:
                names += tuple(_WORD.findall(v.lower()))[:12]
        if tag not in _INLINE or (tag == "ins" and names):
            self._end_block()
            for other in _CLOSES.get(tag, ()) if tag in _VOID else (*_CLOSES.get(tag, ()), "p"):
                while self.kept[-1][other] > 0:
                    self._pop(other)
        if tag not in _VOID:
            self._push(tag, names)

    def parse_comment(self, i: int, report: int = 1) -> int:
        """A comment that nothing closes goes to the end of the page."""
        return super().parse_comment(i, report) if self.rawdata.find("-->", i) >= 0 else len(self.rawdata)

    def parse_starttag(self, i: int) -> int:
        """Nothing is searched for in a rest that closes no tag."""
        return super().parse_starttag(i) if self.rawdata.find(">", i) >= 0 else -1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if self.silent:
            if tag == self.silent:
                self.silent = None
            return
        if tag in _INLINE:
            if self.solid[-1][tag] > 0:
                if tag == "ins" and next(n.names for n in self.stack[::-1] if n.tag == tag):
                    self._end_block()
                self._pop(tag)
            return
        self._end_block()
        if self.open[tag] > 0:
            self._pop(tag)

    def handle_data(self, data: str) -> None:
        if self.silent:
            return
        if self.node is None and not data.isspace():
            self.node = self.stack[-1]
        self.parts.append(data)
        if self.links:
            self.linked += len(data)


def leaf_blocks(html: str, root: Node | None = None) -> list[Block]:
    """The leaf blocks of a page, in order; their nodes are below ``root``."""
    parser = _Parser(root or Node())
    parser.feed(html)
    parser.close()
    parser._end_block()
    return parser.blocks


def _own_features(node: Node) -> list[str]:
    """What an element tells about all that it holds."""
    return [*([] if node.tag in _INLINE else [f"in:{node.tag}"]), *(f"name:{n}" for n in node.names)]


def _near_features(node: Node) -> list[str]:
    """What the block elements right around a text tell."""
    solid = [n.tag for n in islice((n for n in node.path() if n.tag not in _INLINE), 2)]
    return ["bias", f"parent:{solid[0] if solid else ''}", f"near:{'/'.join(solid[::-1])}"]


def _text_features(b: Block) -> list[str]:
    n, words = len(b.text), b.text.count(" ") + 1
    share = min(1.0, b.linked / n)
    out = [f"words:{min(7, int(math.log2(words)))}", f"linked:{0 if share < 0.1 else 1 if share < 0.5 else 2}"]
    if b.text[-1] in ".!?…":
        out.append("stop")
    if "©" in b.text:
        out.append("legal")
    if b.plain:
        out += ["plain", f"plain-{out[0]}"]
    return out


@dataclass
class Extractor:
    """A trained chain and the numbers of its features."""

    chain: crf.Crf
    numbers: dict[str, int]
    root: Node = field(default_factory=Node)
    nodes: int = 0
    texts_known: dict[tuple, np.ndarray] = field(default_factory=dict)
    telling: set[int] | None = None

    def __getstate__(self) -> dict:
        return {"chain": self.chain, "numbers": self.numbers, "root": Node(), "nodes": 0, "texts_known": {}, "telling": None}

    def _numbers(self, features: list[str]) -> list[int]:
        return [self.numbers[f] for f in features if f in self.numbers]

    def known(self, node: Node) -> frozenset[int]:
        """Numbers of the features of an element and all around it; shared with the element around it where it adds none."""
        missing = []
        while node.known is None:
            missing.append(node)
            if node.above is None:
                node.known = frozenset()
            else:
                node = node.above
        for inner in missing[::-1]:
            if inner.above is not None:
                added = frozenset(self._numbers(_own_features(inner)))
                inner.known = inner.above.known if added <= inner.above.known else inner.above.known | added
                self.nodes += 1
        return (missing[0] if missing else node).known

    def mark(self, page: list[Block]) -> None:
        """Mark the blocks of a page without any element or name that tells main text from the rest."""
        telling = {n for f, n in self.numbers.items() if f.startswith("name:") or f in _TELLING} if self.telling is None else self.telling
        self.telling = telling
        plain = all(telling.isdisjoint(self.known(b.node)) for b in page)
        for b in page:
            b.plain = plain

    def matrix(self, blocks: list[Block]) -> np.ndarray:
        """Features of each block, to train on."""
        x = np.zeros((len(blocks), len(self.numbers)), np.float32)
        for i, b in enumerate(blocks):
            x[i, [*self.known(b.node), *self._numbers(_near_features(b.node)), *self._numbers(_text_features(b))]] = 1
        return x

    def emissions(self, blocks: list[Block]) -> np.ndarray:
        """Score of each label of each block; an element's share and a text's share are worked out once."""
        out = np.empty((len(blocks), 2))
        for i, b in enumerate(blocks):
            if b.node.weight is None:
                b.node.weight = self.chain.emit[sorted({*self.known(b.node), *self._numbers(_near_features(b.node))})].sum(0)
            shape = tuple(_text_features(b))
            if shape not in self.texts_known:
                self.texts_known[shape] = self.chain.emit[self._numbers(list(shape))].sum(0)
            out[i] = b.node.weight + self.texts_known[shape]
        return out

    def texts(self, pages: list[str]) -> list[str]:
        """Main text of each page."""
        out = [""] * len(pages)
        lo = 0
        while lo < len(pages):  # as many pages as give a bounded number of blocks; a longer page stands alone
            hi, blocks, cuts = lo, [], []
            while hi < len(pages) and len(blocks) <= 4000:
                if self.nodes > MOST_NODES:
                    self.root, self.nodes = Node(), 0
                own = leaf_blocks(pages[hi], self.root)
                self.mark(own)
                blocks += own
                cuts.append(len(own))
                hi += 1
            if blocks:
                label = iter(crf.decode(self.chain, self.emissions(blocks), np.array(cuts)).tolist())
                block = iter(blocks)
                for i, n in enumerate(cuts, lo):
                    out[i] = " ".join([b.text for b in islice(block, n) if next(label)])
            lo = hi
        return out


def train(seeds: range) -> Extractor:
    """An extractor trained on the labelled pages of these seeds."""
    pages, labels = [], []
    for seed in seeds:
        blocks = leaf_blocks(marked_page(seed))
        marks = [MAIN_MARK in b.text for b in blocks]
        for b in blocks:
            b.text = b.text.replace(MAIN_MARK, "").replace(REST_MARK, "") or " "
        pages.append(blocks)
        labels += marks
    uses = Counter(f for p in pages for b in p for f in {*(f for n in b.node.path() for f in _own_features(n)), *_near_features(b.node), *_text_features(b)})
    shapes = {f"plain-words:{k}" for k in range(8)}
    numbers = {f: i for i, f in enumerate(sorted({f for f, n in uses.items() if n >= LEAST_USES} | {"plain"} | shapes))}
    own = Extractor(crf.Crf.zeros(len(numbers), 2), numbers)
    for page in pages:
        own.mark(page)
    x = own.matrix([b for p in pages for b in p])
    own.chain = crf.train(x, np.array(labels).astype(int), np.array([len(p) for p in pages]), 2, ridge=5e-5, rounds=120)
    return own


@lru_cache(maxsize=1)
def extractor() -> Extractor:
    """The extractor trained on the standard pages."""
    return train(range(TRAINING_PAGES))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url and text of each row."""
    kind = pages.select(id_col).dtypes[0][1]
    model = extractor()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, BATCH_BYTES, 256):
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(model.texts(part.column(2).to_pylist()), pa.string())], ["page_id", "url", "text"])

    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), text_or_empty(html_col).alias("html")).mapInArrow(run, f"page_id {kind}, url string, text string")
