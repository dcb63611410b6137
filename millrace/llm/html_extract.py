"""Main text of web pages from flat text blocks and a decision tree.

A page is read once into flat blocks: runs of text between block-level tags, each with its word count and
link density. A block is described by these two figures, by those of its neighbours (the block before and the one after; none at
the ends of the page), and by whether it is a heading. A decision tree, grown in numpy on the small labelled
table below, tells main text from the rest; blocks it accepts are joined in page order.

Menus, link lists, teasers, adverts, notices and footers of few words are told by these figures alone, whatever their tags and names. What
figures can't tell is a long unlinked text that is no part of the article (a sidebar, a comment, a consent text), or a short one among unlinked neighbours. The tree may
therefore also ask for marks: whether a block lies in an article, in furniture, or beside the article that the page has. Short blocks outside of an article have marks only
where both of their neighbours are there and have no links, so that figures say nothing. The table holds every page with and without its marks.

Names of furniture are whole class tokens, or the first or last part of one (``ad-slot``, ``site-footer``), not any part
(``has-sidebar``, ``tag-economy``); they don't count on html, body, main and article, nor, like ``form``, on a wrapper that holds
the main heading or article and most words of the page.

One Arrow map: no shuffle, memory bounded by a batch. Reading is linear in the page: every pattern is possessive.

Defined cases: null html is empty and gives an empty text; bytes that are not UTF-8 are read as the replacement character; very long pages are read whole; a page without main text gives an
empty text; a leaf of the tree that holds as many blocks of either kind accepts; null ids and urls pass through; repeated rows
are extracted each; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/>]*+)([^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+|[^>]*+)(?:>|\Z)|<", re.DOTALL)
_NAMED = re.compile(r"(?:^|[\s\"'/])(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"']++))", re.IGNORECASE)

# How HTML elements take part.
SKIPPED = frozenset("script style noscript template svg math canvas iframe object head title textarea select button option datalist audio video".split())
RAW = frozenset("script style noscript template textarea title iframe svg".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br input link meta base".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog".split())
MAIN_TAGS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion comment comments commentlist disqus reply replies respond "
    "cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe subscription signup sidebar side widget related recommended recommendations "
    "share sharing social nav navbar navigation menu breadcrumb breadcrumbs footer masthead topbar toolbar pagination pager tags search login complementary contentinfo".split()
)
#: A name that begins with one of these says something about the page, not about the element.
STATE_PARTS = frozenset("has have no not with without is js tag tags category".split())
WRAPPERS = frozenset("html body main article".split())

#: What describes a block, in this order. ``around`` is 1 in an article, -1 in furniture or beside the page's article, 0 if nothing is known or the figures can tell.
FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "heading", "around")
LONG = 16

# The labelled table: pages as their blocks in order, each "words links element around label"; element is h(eading) or, which makes no difference, p(aragraph) or o(ther);
# around a (article), f (furniture, or beside an article) or . (nothing known), label + is main text. Pages with marks are taken without them too, but for blocks that only marks can tell.
LABELLED = """
1 1 o . -, 1 1 o . -, 1 1 o . -, 2 2 o . -, 8 0 o . -, 9 0 h a +, 60 0 p a +, 34 2 p a +, 1 0 p a +, 90 0 p a +, 3 0 p a +, 9 0 o . -
1 1 o . -, 2 2 o . -, 1 1 o . -, 13 0 o . -, 7 0 h a +, 14 0 p a +, 2 0 p a +, 7 0 p a +, 40 0 p a +, 1 0 p a +, 6 0 o . -
3 3 o . -, 1 1 o . -, 5 0 o . -, 12 0 h a +, 4 0 p a +, 1 0 p a +, 2 0 p a +, 5 0 p a +, 3 0 p a +, 14 0 o . -
1 1 o . -, 1 1 o . -, 10 0 h a +, 2 0 p a +, 120 0 p a +, 15 0 p a +, 33 1 p a +, 62 0 p f -, 9 9 o . -, 7 0 o . -
1 1 o . -, 1 1 o . -, 11 0 h . +, 45 0 p . +, 70 0 p . +, 21 0 p . +, 8 8 o . -, 9 9 o . -, 11 10 o . -, 5 0 o . -
2 2 o . -, 2 2 o . -, 6 0 h a +, 31 0 p a +, 9 0 p a +, 27 0 p a +, 8 8 p a -, 24 0 p a +, 12 0 p f -, 1 0 h f -, 40 0 p a +, 4 0 o . -, 2 2 o . -, 2 2 o . -
4 4 o . -, 3 3 o . -, 22 0 o f -, 8 0 h . +, 55 0 p . +, 12 3 p . +, 90 0 p . +, 7 6 p . -, 64 2 p . +, 3 0 h . +, 30 0 p . +, 11 0 o . -
1 1 o . -, 1 1 o . -, 1 1 o . -, 9 0 h a +, 28 0 o a +, 20 0 o a +, 4 0 o a +, 26 0 o a +, 17 0 o a +, 1 1 o . -, 1 1 o . -, 3 0 o . -
6 6 o . -, 5 5 o . -, 7 0 o . -, 8 0 h . +, 65 0 p . +, 38 1 p . +, 47 0 p . +, 35 22 o . -, 18 18 o . -, 40 36 o . -
1 1 o . -, 2 2 o . -, 5 0 h . +, 20 0 p . +, 3 0 h . +, 25 0 p . +, 4 0 h . +, 6 0 o . +, 7 0 o . +, 5 0 o . +, 33 0 p . +, 6 0 o . -
1 1 o . -, 10 0 o . -, 12 0 h a +, 150 0 p a +, 48 9 p a +, 11 0 p a +, 75 0 p a +, 54 0 o f -, 80 3 o f -, 30 0 p f -, 4 0 o . -
3 3 o . -, 3 3 o . -, 9 7 o . -, 6 6 o . -, 7 6 o . -, 2 2 o . -, 3 3 o . -
12 12 o . -, 14 12 o . -, 11 11 o . -, 30 27 o . -, 8 0 h . +, 65 0 p . +, 38 1 p . +, 47 0 p . +, 25 22 o . -, 18 18 o . -, 4 4 o . -
4 0 h . +, 100 4 p . +, 30 0 p . +, 8 0 p . +, 26 0 p . +, 1 1 o . -, 1 1 o . -, 7 0 o . -
17 0 o f -, 45 0 o f -, 10 0 h a +, 4 0 p a +, 35 0 p a +, 25 4 p a +, 28 0 p a +, 90 0 p f -, 20 0 p f -, 20 20 o . -
7 0 h . +, 16 0 p . +, 28 2 p . +, 3 0 h . +, 55 0 p . +, 14 0 p . +, 90 0 p . +, 6 4 o . -, 8 7 o . -, 2 2 o . -
1 1 o . -, 2 2 o . -, 20 0 o . +, 24 0 o . +, 22 0 o . +, 19 0 o . +, 21 0 o . +, 25 0 o . +, 5 0 o . -
9 0 h a +, 40 0 p a +, 5 5 p a -, 44 0 p a +, 3 3 o a -, 2 2 o a -, 40 0 p f -, 12 0 o . -
2 2 o . -, 1 1 o . -, 6 0 o . -, 8 0 h a +, 3 0 p a +, 1 0 p a +, 1 0 p a +, 12 0 p a +, 2 0 p a +, 8 0 o . -
1 1 o . -, 1 1 o . -, 21 0 p . +, 17 0 p . +, 10 0 p . +, 15 0 p . +, 13 0 p . +, 4 3 o . -, 5 4 o . -
1 1 o . -, 15 0 o . -, 20 0 h a +, 28 0 p a +, 90 0 p a +, 2 0 p a +, 15 0 o . -
6 0 h . +, 30 0 p . +, 50 0 p . +, 41 0 p . +
1 1 o . -, 1 1 o . -, 12 0 o . -, 20 0 h a +, 3 0 p a +, 26 0 p a +, 9 0 o . -
2 2 o . -, 1 1 o . -, 5 0 o . -, 16 0 h . +, 60 0 p . +, 1 0 p . +, 18 0 o f -
1 1 o . -, 1 1 o . -, 14 0 o . -, 24 0 h . +, 18 0 p . +, 8 0 p . +, 12 0 o . -
20 0 o . +, 20 0 o . +, 20 0 o . +, 20 0 o . +, 18 0 o . +, 16 0 o . +, 20 0 o . +, 17 0 o . +
4 4 o . -, 60 0 p a +
1 0 h a +, 40 0 p a +
3 3 o . -, 1 0 h a +, 4 0 p a +, 3 0 p a +, 2 0 p a +
8 0 h a +, 6 0 p a +, 5 0 p a +, 54 0 o f -
5 0 p a +, 90 0 p a +, 20 0 p a +, 3 0 p a +, 1 1 o a -, 1 1 o a -
2 2 o . -, 1 1 o . -, 8 0 o . -, 11 0 h a +, 50 0 p a +, 13 0 p a +, 79 0 p a +, 16 0 o f -
1 1 o . -, 2 2 o . -, 9 0 o . -, 12 0 h a +, 33 0 p a +, 12 0 p a +, 18 0 o f -
1 1 o . -, 1 1 o . -, 6 0 o . -, 9 0 h a +, 3 0 p a +, 70 0 p a +, 24 0 o f -
4 0 h a +, 40 0 p a +, 12 0 p f -, 1 0 h f -, 30 0 p a +
6 0 h a +, 22 0 p a +, 9 0 p f -, 19 0 p a +
2 2 o . -, 2 2 o . -, 9 0 h . +, 30 0 p . +, 60 0 p . +, 1 0 o . -
1 1 o . -, 9 0 h . +, 44 0 p . +, 7 0 p . +, 2 0 o . -
1 0 h . -, 1 1 o . -, 1 1 o . -, 8 0 o . -, 4 0 h a +, 12 1 p a +, 2 0 p a +, 3 0 o f -, 6 0 p f -, 1 0 o f -, 8 0 p f -, 2 0 o . -
3 0 h . -, 1 1 o . -, 2 2 o . -, 9 0 h a +, 40 0 p a +, 3 0 p a +, 5 0 o f -, 9 0 o . -
2 0 h . -, 2 2 o . -, 1 1 o . -, 12 0 h . +, 30 0 p . +, 25 0 p . +, 10 0 o . -
"""


def described(rows: list[tuple]) -> list[tuple]:
    """The features of each of a page's blocks (words, link density, heading, around), in order."""
    out = []
    for i, (words, links, heading, around) in enumerate(rows):
        b = rows[i - 1] if i else (0, 0.0)
        a = rows[i + 1] if i + 1 < len(rows) else (0, 0.0)
        out.append((words, links, b[0], b[1], a[0], a[1], heading, around))
    return out


#: Each labelled page is taken at several sizes of its long blocks: an article's paragraphs may be of any length.
SIZES = (1, 1.4, 4)


@lru_cache(maxsize=1)
def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of LABELLED."""
    x, y = [], []
    for line in LABELLED.strip().split("\n"):
        blocks = [b.split() for b in line.split(", ")]
        words = [int(b[0]) for b in blocks]
        plain = min(words[:1] + words[-1:]) < LONG <= max(words)  # nothing is known of an article that ends with the page
        for size in SIZES:
            grown = [round(n * size) if n >= LONG else n for n in words]
            for marked in (True, False) if plain else (True,):
                marks = [{".": 0, "a": int(marked), "f": -1}[b[3]] for b in blocks]
                x += described([(n, int(b[1]) / int(b[0]), b[2] == "h", m) for n, b, m in zip(grown, blocks, marks, strict=True)])
                y += [b[4] == "+" for b in blocks]
    return np.array(x, float), np.array(y, float)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8) -> tuple | float:
    """A decision tree by Gini impurity: (feature, threshold, below, above) or the share of ones at a leaf."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0):
        return share
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            low = x[:, f] < t
            p, q = y[low].mean(), y[~low].mean()
            impurity = low.mean() * p * (1 - p) + (1 - low.mean()) * q * (1 - q)
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, float(t))
    if best is None:
        return share
    low = x[:, best[1]] < best[2]
    return (best[1], best[2], grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


@lru_cache(maxsize=1)
def default_tree() -> tuple | float:
    return grow(*labelled_table())


def accepts(tree: tuple | float, row: tuple) -> bool:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] < tree[1] else tree[3]
    return tree >= 0.5


_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


@lru_cache(maxsize=4096)
def _named(names: str) -> bool:
    """Whether a class, id, role or label names furniture."""
    for token in names.split():
        parts = [x for x in re.split(r"[-_:]+", _CAMEL.sub("-", token).lower()) if x]
        if parts and (parts in (["tag"], ["tags"]) or parts[0] not in STATE_PARTS) and (parts[0] in FURNITURE_NAMES or parts[-1] in FURNITURE_NAMES):
            return True
    return False


def _furniture(tag: str, attributes: str, in_main: bool) -> tuple[bool, bool]:
    """Whether an element is furniture, and whether only by its name or as a form, which a wrapper of the article may be too."""
    if tag in SKIPPED or (tag in FURNITURE_TAGS and tag != "form") or (tag == "header" and not in_main):
        return True, False
    named = tag == "form" or (tag not in WRAPPERS and "=" in attributes and any(_named(a or b or c) for a, b, c in _NAMED.findall(attributes)))
    return named, named


class Blocks:
    """Flat blocks of a page: text, words, link density, and what encloses them."""

    def __init__(self, page: str):
        self.rows: list[tuple[str, int, float, bool, tuple[int, ...], bool]] = []
        self.parts: list[str] = []
        self.link_words = 0
        self.stack: list[tuple[str, bool, tuple[int, ...]]] = []  # tag, in main, furniture around (numbers of wrappers; -1: certain)
        self.own: tuple[int, ...] = ()  # of a paragraph or heading
        self.wrappers: list[list] = []  # words inside, whether a main heading or article is inside
        self.links = 0
        self.heading = False
        self.page = page
        self._read()

    def _text(self, raw: str) -> None:
        self.parts.append(raw)
        if self.links:
            self.link_words += len(raw.split())

    def _around(self) -> tuple[bool, tuple[int, ...]]:
        return self.stack[-1][1:] if self.stack else (False, ())

    def _end_block(self) -> None:
        if self.parts:
            text = " ".join(entities.unescape("".join(self.parts)).split())
            if text:
                words = text.count(" ") + 1
                main, around = self._around()
                around += self.own
                self.rows.append((text, words, min(1.0, self.link_words / words), main, around, self.heading))
                for k in set(around):
                    if k >= 0:
                        self.wrappers[k][0] += words
            self.parts, self.link_words = [], 0

    def _enclosing(self, tag: str, attributes: str, main: bool) -> tuple[int, ...]:
        furniture, doubtful = _furniture(tag, attributes, main)
        if not furniture:
            return ()
        if not doubtful:
            return (-1,)
        self.wrappers.append([0, False])
        return (len(self.wrappers) - 1,)

    def _read(self) -> None:
        page, at = self.page, 0
        while (m := _TOKEN.search(page, at)) is not None:
            if m.start() > at:
                self._text(page[at : m.start()])
            at = m.end()
            if m[2] is None:
                if m[0] == "<":
                    self._text("<")
                continue
            closing, tag, attributes = bool(m[1]), m[2].lower(), m[3]
            if tag in RAW and not closing and not attributes.rstrip().endswith("/"):
                end = _closing(tag).search(page, at)
                at = end.end() if end else len(page)
                self._end_block()
                continue
            if tag == "a":
                self.links = 0 if closing else 1
            elif tag == "br":
                self.parts.append(" ")
            if tag in INLINE:
                continue
            self._end_block()
            self.links, self.own = 0, ()
            self.heading = tag in HEADINGS and not closing
            main, around = self._around()
            if tag == "p" or tag in HEADINGS:
                if not closing:
                    self.own = self._enclosing(tag, attributes, main)
                    if tag == "h1" and not self.own:
                        self._holds_main(around)
                continue
            if tag in VOID:
                continue
            if closing:
                for k in range(len(self.stack) - 1, -1, -1):
                    if self.stack[k][0] == tag:
                        del self.stack[k:]
                        break
            else:
                if tag in MAIN_TAGS:
                    self._holds_main(around)
                self.stack.append((tag, main or tag in MAIN_TAGS, around + self._enclosing(tag, attributes, main or tag in MAIN_TAGS)))
        if at < len(page):
            self._text(page[at:])
        self._end_block()

    def _holds_main(self, around: tuple[int, ...]) -> None:
        for k in around:
            if k >= 0:
                self.wrappers[k][1] = True

    def described(self) -> list[tuple]:
        """The features of each block."""
        most = sum(r[1] for r in self.rows) / 2
        cleared = {k for k, (words, main) in enumerate(self.wrappers) if main and words > most}
        article = any(main for _, _, _, main, _, _ in self.rows)

        def mark(i: int) -> int:
            _, words, _, main, around, _ = self.rows[i]
            plain = 0 < i < len(self.rows) - 1 and not self.rows[i - 1][2] and not self.rows[i + 1][2]
            if main or words >= LONG or plain:
                return -1 if any(k not in cleared for k in around) or (article and not main) else int(main)
            return 0

        return described([(r[1], r[2], r[5], mark(i)) for i, r in enumerate(self.rows)])


@lru_cache(maxsize=64)
def _closing(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}[^>]*+(?:>|\Z)", re.IGNORECASE)


def extract_text(page: str | None, tree: tuple | float | None = None) -> str:
    blocks = Blocks(page or "")
    tree = default_tree() if tree is None else tree
    return "\n".join(r[0] for r, f in zip(blocks.rows, blocks.described(), strict=True) if accepts(tree, f))


def extract(pages: DataFrame, *, html_column: str = "html", keep: list[str] | None = None, tree: tuple | float | None = None) -> DataFrame:
    """The ``keep`` columns (by default page_id and url), text and n_chars (code points) of every page."""
    keep = keep or ["page_id", "url"]
    source = pages.select(*[pages[c] for c in keep], F.make_valid_utf8(pages[html_column]).alias("__html"))
    schema = source.drop("__html").schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract_text(t.as_py(), tree) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema.names)

    return source.mapInArrow(run, schema)
