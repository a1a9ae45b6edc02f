"""Main text of web pages from flat text blocks and a decision tree.

A page is read as a sequence of text blocks.  A block is described by its number of words, the share of them inside
links, the same of the blocks before and after it, and the elements it stands in.  A decision tree trained on the
small table below decides which blocks are article text.  Pages are independent, so the work is one
map over the table without a shuffle, and a task holds one batch of pages.

A class or id may hint at boilerplate (``sidebar``, ``share`` ...).  It counts for what it names, not for a layout around the article: not where it
only says what the layout has or lacks (``has-sidebar``), nor where the container holds the main element or most of the page's words.

Null or empty html, and pages without article text, give an empty text.  Tags, comments and
references cut off by the end of the page are dropped, or kept as text where they aren't markup.
A very long page is read in one task, in memory proportional to it.  Repeated rows are read alike; there are no ties.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTENT = frozenset("article main".split())
BOILER = frozenset("nav header footer aside form menu dialog button select label fieldset".split())
CONTAINERS = CONTENT | BOILER | frozenset("section div ul ol dl table figure details body".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption caption address summary tr hr".split())
BLOCKS = CONTAINERS | LEAVES
# Elements whose content is never text of the page.
SILENT = frozenset("script style noscript template svg math title iframe textarea object canvas video audio".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notices?|sidebar|side|comments?|replies|respond|disqus|nav\w*|menu|"
    r"breadcrumbs?|footer|header|masthead|share|sharing|social|related|recommended|newsletter|subscribe|signup|login|popup|modal|widget|pagination|tags)(?:$|[\s_-])",
    re.I,
)
# Words that turn a hint into its opposite, or into a remark on the layout.
_REMARK = re.compile(r"(?:^|(?<=[\s_-]))(?:has|have|with|no|not|without|hide|hidden|show|shows|is|in|on|before|after|above|below)[_-]\w+", re.I)
# What readers write may be longer than the article.
TALK = re.compile(r"(?:^|[\s_-])(?:comments?|replies|respond|disqus)(?:$|[\s_-])", re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


@dataclass(slots=True)
class Block:
    text: str
    words: int
    linked: int
    content: bool  # inside article or main
    boiler: bool  # inside an element that holds no article text, by its name, class or id
    heading: bool
    item: bool


# Fixed training table.  A page is a list of blocks: elements from the outside in, with a class after a dot; words;
# words in links; whether it is article text.
LABELLED = [
    [
        ("nav ul li", 1, 1, 0), ("nav ul li", 1, 1, 0), ("nav ul li", 2, 2, 0), ("div.ad", 9, 0, 0), ("article h1", 8, 0, 1), ("article p", 90, 0, 1),
        ("article p", 1, 0, 1), ("article p", 45, 4, 1), ("article p", 3, 0, 1), ("footer", 12, 0, 0),
    ],
    [
        ("header h1", 3, 3, 0), ("nav ul li", 1, 1, 0), ("nav ul li", 1, 1, 0), ("main h1", 6, 0, 1), ("main p", 70, 2, 1), ("main ul li", 6, 0, 1),
        ("main ul li", 9, 0, 1), ("main p", 2, 0, 1), ("aside h3", 2, 0, 0), ("aside ul li", 6, 6, 0), ("footer p", 20, 6, 0),
    ],
    [
        ("div.cookie p", 25, 3, 0), ("div.menu ul li", 1, 1, 0), ("div.menu ul li", 2, 2, 0), ("div h2", 7, 0, 1), ("div p", 80, 3, 1), ("div p", 60, 0, 1),
        ("div p", 35, 1, 1), ("div.sidebar p", 30, 2, 0), ("div.comments p", 40, 0, 0), ("div.comments p", 12, 0, 0), ("div.footer", 9, 3, 0),
    ],
    [
        ("header p", 30, 0, 0), ("article header h1", 9, 0, 1), ("article p", 120, 0, 1), ("article blockquote", 30, 0, 1), ("article div.advert", 14, 2, 0),
        ("article p", 55, 5, 1), ("article p", 4, 4, 1), ("article section.comments h3", 1, 0, 0), ("article section.comments p", 60, 0, 0),
        ("article form", 8, 0, 0), ("article footer", 15, 2, 0),
    ],
    [
        ("ul li", 2, 2, 0), ("ul li", 1, 1, 0), ("ul li", 3, 3, 0), ("div h1", 8, 0, 1), ("div p", 40, 0, 1), ("div p", 75, 6, 1), ("div p", 18, 0, 1),
        ("ul li", 5, 5, 0), ("ul li", 7, 7, 0), ("div", 6, 2, 0), ("div", 4, 4, 0),
    ],
    [
        ("nav a", 1, 1, 0), ("form label", 2, 0, 0), ("form button", 1, 0, 0), ("article h2", 5, 0, 1), ("article p", 30, 30, 1), ("article p", 200, 0, 1),
        ("article ul li", 3, 0, 1), ("article ol li", 12, 12, 1), ("aside.notice p", 45, 0, 0), ("footer p", 60, 0, 0),
    ],
    [
        ("div.banner", 18, 0, 0), ("td", 1, 1, 0), ("td", 2, 2, 0), ("td p", 66, 0, 1), ("td p", 48, 2, 1), ("td", 3, 0, 0), ("td", 2, 2, 0), ("p", 14, 9, 0),
    ],
    [
        ("nav ul li", 1, 1, 0), ("nav ul li", 1, 1, 0), ("nav ul li", 1, 1, 0), ("div.ad", 2, 0, 0), ("article h1", 5, 0, 1), ("article p", 150, 0, 1),
        ("article p", 1, 0, 1), ("article p", 2, 0, 1), ("article p", 80, 0, 1), ("article p", 1, 1, 1), ("footer", 2, 0, 0),
    ],
    [("nav ul li", 1, 1, 0), ("div.ad", 30, 0, 0), ("article p", 300, 0, 1), ("article p", 2, 0, 1), ("footer", 1, 0, 0)],
    [("nav ul li", 2, 2, 0), ("div.ad", 1, 0, 0), ("article h1", 7, 0, 1), ("footer", 12, 0, 0)],
    [("article h1", 1, 0, 1), ("article p", 1, 0, 1), ("footer", 1, 1, 0)],
    [("main h1", 4, 0, 1), ("main p", 40, 0, 1), ("main li", 2, 0, 1), ("main li", 1, 0, 1), ("main li", 3, 3, 1), ("main p", 110, 0, 1), ("main p", 2, 0, 1)],
    [
        ("article h1", 6, 0, 1), ("article p", 30, 0, 1), ("article p", 20, 10, 1), ("article p", 3, 1, 1), ("article p", 12, 0, 1), ("article p", 10, 6, 1),
        ("article p", 2, 0, 1), ("article li", 4, 2, 1), ("article li", 9, 3, 1), ("article li", 1, 0, 1), ("article p", 14, 7, 1), ("article p", 8, 0, 1),
    ],
    [("div", 5, 0, 0), ("div", 6, 3, 0), ("div", 7, 0, 0), ("div", 9, 4, 0), ("div p", 90, 2, 1), ("div p", 22, 9, 1), ("div p", 64, 0, 1), ("div", 4, 2, 0)],
    [
        ("div", 30, 28, 0), ("div h2", 5, 0, 1), ("div p", 12, 0, 1), ("div p", 15, 0, 1), ("div p", 44, 3, 1), ("div p", 14, 1, 1), ("div", 24, 22, 0),
        ("div", 40, 33, 0),
    ],
    [("div", 18, 17, 0), ("div p", 25, 0, 1), ("div p", 13, 0, 1), ("div p", 16, 2, 1), ("div p", 11, 0, 1), ("div", 4, 0, 0), ("div", 3, 3, 0)],
    [("article p", 64, 0, 1), ("article p", 2, 2, 1), ("article p", 2, 0, 1), ("article p", 37, 0, 1), ("td", 2, 0, 0), ("td", 3, 1, 0)],
    [
        ("ul li", 1, 1, 0), ("ul li", 2, 2, 0), ("div h1", 7, 0, 1), ("div p", 6, 0, 1), ("div p", 64, 0, 1), ("div p", 4, 0, 1), ("div p", 81, 2, 1),
        ("div p", 9, 0, 1), ("div p", 47, 0, 1), ("div", 5, 2, 0), ("div", 3, 3, 0),
    ],
    [("ul li", 1, 1, 0), ("div h1", 5, 0, 1), ("div p", 6, 0, 1), ("div p", 70, 3, 1), ("div p", 7, 0, 1), ("div p", 55, 0, 1), ("ul li", 4, 4, 0)],
    [("ul li", 3, 3, 0), ("div h1", 9, 0, 1), ("div p", 5, 0, 1), ("div p", 110, 0, 1), ("div", 6, 6, 0)],
    [("p", 33, 0, 1), ("p", 52, 1, 1), ("p", 27, 0, 1), ("p", 5, 0, 1), ("p", 41, 0, 1), ("div.share", 3, 3, 0), ("div.related ul li", 8, 8, 0)],
]


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block: words, link density, both for the neighbours, then what it stands in."""
    words = np.array([0, *[b.words for b in blocks], 0], dtype=np.float64)
    density = np.array([1.0, *[b.linked / b.words for b in blocks], 1.0])
    flags = np.array([(b.content, b.boiler, b.heading, b.item) for b in blocks], dtype=np.float64).reshape(-1, 4)
    near = [words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:]]
    return np.concatenate([np.stack(near, axis=1), flags], axis=1)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8) -> tuple:
    """Decision tree by Gini impurity: (feature, threshold, tree of rows up to it, tree of the others), or a leaf's label."""
    share = y.mean()
    if depth == 0 or share in (0, 1):
        return (bool(share >= 0.5),)
    best = (2 * share * (1 - share) - 1e-9, -1, 0.0)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[:-1] + values[1:]) / 2:
            left = x[:, f] <= cut
            gini = sum(s.mean() * 2 * y[s].mean() * (1 - y[s].mean()) for s in (left, ~left))
            if gini < best[0] - 1e-9:
                best = (gini, f, cut)
    if best[1] < 0:
        return (bool(share >= 0.5),)
    left = x[:, best[1]] <= best[2]
    return (best[1], float(best[2]), grow(x[left], y[left], depth - 1), grow(x[~left], y[~left], depth - 1))


def decide(tree: tuple, row: list[float]) -> bool:
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0]


@dataclass(slots=True)
class _Hinted:
    """A container whose class or id hints at boilerplate, and what speaks against that."""

    talk: bool
    words: int = 0
    main: bool = False
    article: bool = False

    def holds(self, page_words: int) -> bool:
        """Whether the hint counts: it does not for the layout around an article, only for a part beside it."""
        if self.talk:
            return True
        around = 2 * self.words > page_words or (self.article and self.words >= 60 and 4 * self.words > page_words)
        return not (self.main or around)


class _Reader:
    """Flat text blocks of one page."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.inside: list[list[_Hinted]] = []  # of each block, the hinted containers around it
        self.open: list[tuple[str, _Hinted | None]] = []  # containers
        self.leaf, self.leaf_hint = "", False
        self.texts: list[str] = []
        self.linked: list[str] = []
        self.links = 0

    def end_block(self) -> None:
        words = "".join(self.texts).split()
        if words:
            names = {n for n, _ in self.open}
            content = bool(names & CONTENT)
            heading = self.leaf in HEADINGS
            own_header = content and heading  # a heading in an article's own header is its title
            boiler = self.leaf_hint or any(n in BOILER and not (own_header and n == "header") for n, _ in self.open)
            self.inside.append(hints := [h for _, h in self.open if h is not None])
            for hint in hints:
                hint.words += len(words)
            linked = min(len("".join(self.linked).split()), len(words))
            self.blocks.append(Block(" ".join(words), len(words), linked, content, boiler, heading, self.leaf in ("li", "dd", "dt")))
        self.texts, self.linked, self.leaf, self.leaf_hint = [], [], "", False

    def text(self, raw: str) -> None:
        plain = unescape(raw) if "&" in raw else raw
        self.texts.append(plain)
        if self.links:
            self.linked.append(plain)

    def tag(self, closing: bool, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self.end_block()
            self.links = 0
            if name in CONTAINERS:
                if not closing:
                    self.holding(name)
                    self.open.append((name, self.hint(name, attributes)))
                elif any(n == name for n, _ in self.open):
                    while self.open.pop()[0] != name:
                        pass
            elif not closing:
                self.holding(name)
                self.leaf, self.leaf_hint = name, self.hint(name, attributes) is not None
        elif name == "a":
            self.links = max(0, self.links - 1) if closing else self.links + 1
            if self.linked:
                self.linked.append(" ")
        elif name == "br":
            self.texts.append(" ")

    def holding(self, name: str) -> None:
        """Tell the hinted containers around that an element begins which stands for an article."""
        if name in ("main", "article", "h1"):
            for _, hint in self.open:
                if hint is not None:
                    hint.main, hint.article = hint.main or name == "main", True

    @staticmethod
    def hint(name: str, attributes: str) -> _Hinted | None:
        if not attributes or name in CONTENT or name == "body":
            return None
        named = " ".join(_REMARK.sub("", a or b or c) for a, b, c in _NAMED.findall(attributes))
        return _Hinted(bool(TALK.search(named))) if HINT.search(named) else None

    def finished(self) -> list[Block]:
        """The blocks, once it is known which hints count."""
        self.end_block()
        total = sum(b.words for b in self.blocks)
        for block, hints in zip(self.blocks, self.inside, strict=True):
            block.boiler = block.boiler or any(h.holds(total) for h in hints)
        return self.blocks


def read_blocks(html: str) -> list[Block]:
    reader, at, size, low = _Reader(), 0, len(html), html.lower()
    if len(low) != size:  # a letter whose lower case is longer
        low = re.sub("[A-Z]+", lambda m: m[0].lower(), html)
    while at < size:
        start = html.find("<", at)
        if start < 0:
            reader.text(html[at:])
            break
        if start > at:
            reader.text(html[at:start])
        follows = html[start + 1 : start + 2]
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = size if end < 0 else end + 3
        elif follows in ("!", "?"):
            end = html.find(">", start)
            at = size if end < 0 else end + 1
        elif match := _TAG.match(html, start) or _LOOSE_TAG.match(html, start):
            name, at = match[2].lower(), match.end()
            if name in SILENT and not match[1]:
                if not match[3].endswith("/"):
                    end = low.find(f"</{name}", at)
                    end = -1 if end < 0 else low.find(">", end)
                    at = size if end < 0 else end + 1
            else:
                reader.tag(bool(match[1]), name, match[3])
        elif follows.isascii() and (follows.isalpha() or follows == "/"):
            end = html.find(">", start)  # a broken end tag, or a tag cut off by the end of the page
            at = size if end < 0 else end + 1
        else:
            reader.text("<")
            at = start + 1
    return reader.finished()


def labelled_blocks(pages: list = LABELLED) -> tuple[np.ndarray, np.ndarray]:
    rows, kept = [], []
    for page in pages:
        blocks = []
        for path, words, linked, keep in page:
            steps = [s.partition(".") for s in path.split()]
            names = [n for n, _, _ in steps]
            content, heading = bool(CONTENT & set(names)), names[-1] in HEADINGS
            boiler = any(c or (n in BOILER and not (content and heading and n == "header")) for n, _, c in steps)
            blocks.append(Block("", words, linked, content, boiler, heading, names[-1] in ("li", "dd", "dt")))
            kept.append(keep)
        rows.append(features(blocks))
    return np.concatenate(rows), np.array(kept)


def main_text(html: str | None, tree: tuple) -> str:
    blocks = read_blocks(html or "")
    if not blocks:
        return ""
    rows = features(blocks).tolist()
    return "\n".join(b.text for b, row in zip(blocks, rows, strict=True) if decide(tree, row))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", labelled: list = LABELLED) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; n_chars counts code points."""
    tree = grow(*labelled_blocks(labelled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), tree) for h in batch.column(2)]
            arrays = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
