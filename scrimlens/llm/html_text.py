"""Main text of web pages from flat text blocks.

A page becomes a flat list of text blocks. Each has a word count, a link density, the same of the block before and after it, and whether
it stands in the article or in a container that is marked as something else. A decision tree, trained here on a small labelled
table, decides about each block; the tree and the table are the whole model.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrimlens.llm.common import id_in, id_out, slices

# Elements by their part in a page.
_BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
_HIDDEN = frozenset("annotation annotation-xml audio button canvas datalist head iframe map noscript object option script select style svg template textarea title video".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_APART = frozenset("aside dialog footer form menu nav search".split())
_MARKS = frozenset("""ad ads adslot adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments commentlist
consent cookie cookies disqus discussion donate flash footer gdpr hidden login masthead menu message modal nav navbar navigation newsletter
notice notices notification outbrain overlay pager pagination paywall popup promo promoted promotion recommendations recommended related
replies reply respond responses search share sharing sidebar signup skip social sponsor sponsored sponsors subscribe subscription
taboola tags teaser toast toolbar topbar warning widget widgets""".split())
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Names that speak of the layout: what a page has or hasn't, wrappers of the content, and parts hidden on some screens only.
_LAYOUT = re.compile(r"(?:has|with|no|without)[-_].*|hidden[-_](?:xs|sm|md|lg|xl|xxl|print|phone|tablet|desktop|mobile)|(?:content|main|page|site|primary)[-_].*wrap(?:per)?")


class Element:
    """An open element: its place, whether it is the article, whether it stands apart by itself or only by its name, whether its
    text is hidden. What does not change any more is carried down from the element above: whether anything up to here stands
    apart by itself, and the outermost main element and article."""

    def __init__(self, tag: str, above: Element | None, article: bool, apart: bool, named: bool, hidden: bool) -> None:
        self.tag, self.above, self.article, self.apart, self.named, self.hidden = tag, above, article, apart, named, hidden
        self.within_apart = apart or bool(above and above.within_apart)
        self.main: Element | None = above.main if above and above.main else self if tag == "main" else None
        self.outer: Element | None = above.outer if above and above.outer else self if tag == "article" else None

    def path(self) -> Iterator[Element]:
        place: Element | None = self
        while place:
            yield place
            place = place.above


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    article: bool
    apart: bool
    element: Element | None


class _Reader(HTMLParser):
    """Collects the text blocks; elements that are never closed end with the container around them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[Element] = []
        self.tags: Counter[str] = Counter()  # of open elements
        self.any_named = False
        self.parts: list[str] = []
        self.link_parts: list[str] = []
        self.link = 0

    def flush(self) -> None:
        words = "".join(self.parts).split()
        if words:
            element = self.open[-1] if self.open else None
            self.blocks.append(Block(" ".join(words), len(words), min(len(words), len("".join(self.link_parts).split())), bool(element and element.article), False, element))
        self.parts, self.link_parts = [], []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.handle_data("\n")
        if tag in _BLOCKS:
            self.flush()
        if tag in _VOID:
            return
        if tag == "a":
            self.link = 1
        if tag not in _BLOCKS and tag not in _HIDDEN:
            return
        if tag == "p" and self.open and self.open[-1].tag == "p":
            self.tags[self.open.pop().tag] -= 1  # a paragraph ends where the next begins
        above = self.open[-1] if self.open else None
        article, apart, named, hidden = bool(above and above.article), False, False, bool(above and above.hidden)
        given = dict(attrs)
        if tag in ("article", "main"):
            # An article inside something apart, such as a comment or a teaser, stays apart.
            article = True
        elif tag not in ("html", "body"):
            whole = [w for key in ("class", "id") for w in (given.get(key) or "").split() if not _LAYOUT.fullmatch(w.lower())]
            names = {n.lower() for w in whole for n in _NAME.findall(w)}
            named = bool(names & _MARKS) or (not article and "header" in names)
            apart = (given.get("role") or "").lower() in _ROLES or "hidden" in given or given.get("aria-hidden") == "true"
            apart |= "display:none" in (given.get("style") or "").replace(" ", "").lower()
            apart |= tag in _APART or (not article and tag == "header")
        self.open.append(Element(tag, above, article, apart, named, hidden or tag in _HIDDEN))
        self.tags[tag] += 1
        self.any_named |= named

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCKS:
            self.flush()
        if tag == "a":
            self.link = 0
        if self.tags[tag]:  # open somewhere: all that is open inside ends with it
            while True:
                ended = self.open.pop().tag
                self.tags[ended] -= 1
                if ended == tag:
                    break
            self.link = self.link if tag in ("p", "li", "span") else 0

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1].hidden:
            return
        self.parts.append(data)
        if self.link:
            self.link_parts.append(data + " ")


def _marked(blocks: list[Block]) -> list[bool]:
    """Of each block whether an element around it stands apart, by itself or by its name; every element is looked at once."""
    known: dict[int, bool] = {}
    out = []
    for block in blocks:
        trail, place = [], block.element
        while place is not None and id(place) not in known:
            trail.append(place)
            place = place.above
        mark = place is not None and known[id(place)]
        for e in reversed(trail):
            mark = known[id(e)] = mark or e.apart or e.named
        out.append(mark)
    return out


def _holds_another(top: Element, article: Element, articles: list[Element]) -> bool:
    """Whether an element has other outermost articles than this one in it."""
    apart: set[int] = set()
    for other in articles:
        trail, place = [], other
        while place is not None and place is not top and id(place) not in apart:
            trail.append(place)
            place = place.above
        if place is top and other is not article:
            return True
        if place is not top:
            apart.update(map(id, trail))
    return False


def _clear_main(blocks: list[Block]) -> None:
    """Names do not count on the elements around the page's main element: the first <main>, else an article that is alone in what
    bears the name and has more words of its own than all that is not apart."""
    articles: dict[int, list] = {}  # the outermost article of each: element, words that are no links
    free = 0
    for block, marked in zip(blocks, _marked(blocks), strict=True):
        plain = block.words - block.linked
        free += 0 if marked else plain
        main, outer = (block.element.main, block.element.outer) if block.element else (None, None)
        if main and not main.within_apart:
            for e in main.path():
                e.named = False
            return
        if outer and not outer.within_apart:
            articles.setdefault(id(outer), [outer, 0])[1] += plain
    for article, plain in sorted(articles.values(), key=lambda x: -x[1])[:1]:
        named = [e for e in article.path() if e.named]
        if named and plain > free and not _holds_another(named[-1], article, [a for a, _ in articles.values()]):
            for e in named:
                e.named = False


def text_blocks(html: str) -> list[Block]:
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader.flush()
    if reader.any_named:
        _clear_main(reader.blocks)
    return _with_marks(reader.blocks)


def _with_marks(blocks: list[Block]) -> list[Block]:
    return [b._replace(apart=mark) for b, mark in zip(blocks, _marked(blocks), strict=True)]


# ------------------------------------------------------------------------------------------------------ decision tree

#: Small labelled table: words, link density; of the block before; of the block after; in the article; apart from it; label.
LABELLED = [
    # paragraphs, headings and short lines of articles
    (60, 0.0, 45, 0.0, 50, 0.0, 1, 0, 1), (12, 0.0, 60, 0.0, 55, 0.0, 1, 0, 1), (1, 0.0, 40, 0.0, 35, 0.0, 1, 0, 1),
    (9, 0.0, 3, 1.0, 70, 0.0, 1, 0, 1), (7, 0.0, 1, 1.0, 4, 0.0, 1, 0, 1), (2, 0.0, 80, 0.0, 8, 0.1, 1, 0, 1),
    (35, 0.2, 40, 0.0, 30, 0.1, 1, 0, 1), (5, 1.0, 40, 0.0, 30, 0.0, 1, 0, 1), (18, 0.5, 22, 0.1, 9, 0.0, 1, 0, 1),
    (120, 0.0, 0, 0.0, 0, 0.0, 1, 0, 1), (3, 0.0, 0, 0.0, 0, 0.0, 1, 0, 1), (4, 0.0, 2, 0.0, 90, 0.0, 1, 0, 1),
    (2, 1.0, 1, 1.0, 3, 1.0, 1, 0, 1), (1, 1.0, 3, 1.0, 1, 1.0, 1, 0, 1), (4, 0.0, 4, 1.0, 3, 1.0, 1, 0, 1),
    (30, 0.7, 2, 1.0, 25, 0.8, 1, 0, 1), (2, 0.0, 3, 0.0, 2, 0.0, 1, 0, 1), (6, 0.0, 5, 0.0, 0, 0.0, 1, 0, 1),
    (5, 0.0, 6, 0.0, 3, 0.5, 1, 0, 1), (1, 0.0, 2, 0.0, 12, 0.4, 1, 0, 1), (8, 0.4, 20, 0.0, 9, 0.1, 1, 0, 1),
    (3, 0.0, 50, 0.0, 8, 0.0, 1, 0, 1), (12, 0.9, 9, 0.0, 4, 0.0, 1, 0, 1), (7, 0.1, 1, 0.0, 60, 0.9, 1, 0, 1),
    (1, 0.0, 0, 0.0, 1, 0.0, 1, 0, 1), (2, 0.5, 4, 0.25, 3, 1.0, 1, 0, 1), (9, 1.0, 2, 0.0, 1, 0.0, 1, 0, 1),
    # the same on pages that do not say where the article is
    (70, 0.0, 50, 0.0, 60, 0.0, 0, 0, 1), (40, 0.1, 3, 1.0, 55, 0.0, 0, 0, 1), (90, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1),
    (25, 0.0, 8, 0.0, 40, 0.0, 0, 0, 1), (6, 0.0, 45, 0.0, 50, 0.0, 0, 0, 1), (8, 0.0, 2, 1.0, 60, 0.0, 0, 0, 1),
    (3, 0.0, 60, 0.0, 70, 0.0, 0, 0, 1), (30, 0.0, 60, 0.0, 4, 0.5, 0, 0, 1), (20, 0.15, 35, 0.0, 25, 0.1, 0, 0, 1),
    # menus, link lists, small print outside the article
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0), (3, 1.0, 2, 1.0, 4, 1.0, 0, 0, 0), (2, 1.0, 0, 0.0, 2, 1.0, 0, 0, 0),
    (12, 0.9, 10, 1.0, 14, 0.8, 0, 0, 0), (30, 0.7, 25, 0.8, 20, 0.9, 0, 0, 0), (4, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0),
    (5, 0.0, 4, 1.0, 0, 0.0, 0, 0, 0), (8, 0.4, 60, 0.0, 0, 0.0, 0, 0, 0), (6, 1.0, 50, 0.0, 45, 0.0, 0, 0, 0),
    (1, 1.0, 1, 1.0, 5, 0.0, 0, 0, 0), (2, 1.0, 3, 1.0, 60, 0.0, 0, 0, 0), (4, 1.0, 70, 0.0, 5, 1.0, 0, 0, 0),
    (2, 0.0, 3, 0.0, 2, 0.0, 0, 0, 0), (5, 0.0, 6, 0.0, 3, 0.5, 0, 0, 0), (7, 0.1, 3, 0.0, 5, 0.0, 0, 0, 0),
    # whatever stands apart, in the article's element or not
    (40, 0.0, 50, 0.0, 45, 0.0, 1, 1, 0), (4, 0.0, 60, 0.0, 70, 0.0, 1, 1, 0), (90, 0.0, 80, 0.0, 60, 0.0, 1, 1, 0),
    (3, 1.0, 40, 0.0, 3, 1.0, 1, 1, 0), (15, 0.2, 60, 0.0, 0, 0.0, 1, 1, 0), (60, 0.0, 60, 0.0, 40, 0.0, 0, 1, 0),
    (8, 0.0, 1, 1.0, 9, 0.0, 0, 1, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0), (25, 0.0, 90, 0.0, 0, 0.0, 0, 1, 0),
    (120, 0.0, 3, 1.0, 80, 0.0, 0, 1, 0), (10, 0.0, 0, 0.0, 2, 1.0, 0, 1, 0), (5, 0.0, 70, 0.0, 60, 0.0, 0, 1, 0),
]


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 8) -> tuple | float:
    """A tree of (feature, threshold, at most, above); a leaf is the share of content. Splits lower the Gini impurity most."""
    share = float(labels.mean())
    if depth == 0 or share in (0.0, 1.0):
        return share
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for cut in ((values[1:] + values[:-1]) / 2).tolist():
            left = rows[:, feature] <= cut
            gini = sum(part.sum() * (p := labels[part].mean()) * (1 - p) for part in (left, ~left))
            if best is None or gini < best[0] - 1e-12:
                best = gini, feature, cut, left
    if best is None or best[0] >= len(rows) * share * (1 - share) - 1e-12:
        return share
    _, feature, cut, left = best
    return feature, cut, grow(rows[left], labels[left], depth - 1), grow(rows[~left], labels[~left], depth - 1)


@lru_cache(maxsize=1)
def trained() -> tuple | float:
    table = np.array(LABELLED, float)
    return grow(table[:, :-1], table[:, -1])


def is_content(features: tuple[float, ...], tree: tuple | float) -> bool:
    while isinstance(tree, tuple):
        feature, cut, low, high = tree
        tree = low if features[feature] <= cut else high
    return tree >= 0.5


def _content(blocks: list[Block]) -> list[str]:
    tree = trained()
    sizes = [(0, 0.0), *((b.words, b.linked / b.words) for b in blocks), (0, 0.0)]
    return [b.text for i, b in enumerate(blocks) if is_content((*sizes[i + 1], *sizes[i], *sizes[i + 2], b.article, b.apart), tree)]


def main_text(html: str) -> str:
    blocks = text_blocks(html)
    texts = _content(blocks)
    if not texts:
        # Nothing but what bears such a name: the other features decide about the element around the longest block.
        longest = max((b for b in blocks if not (b.element and b.element.within_apart)), key=lambda b: b.words - b.linked, default=None)
        if longest and longest.apart:
            for e in longest.element.path():
                e.named = False
            texts = _content(_with_marks(blocks))
    return "\n".join(texts)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars.

    Blocks of the article in page order, joined by one line feed; white space within a block, a line break included, is one space,
    character references are decoded. A null or empty page gives an empty text. Each row stands alone, repeated ones alike; a null
    url stays null, other columns are not read, an empty table gives an empty result. A page is read whole, in time that grows
    with its length.
    """
    out = pa.schema([("id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(h or "") for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url").cast(pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=out)

    rows = pages.select(id_in(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "id long, url string, text string, n_chars long").select(id_out("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
