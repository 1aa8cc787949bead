"""Main text of web pages: flat text blocks, their neighbours, and a small decision tree.

A page becomes a flat list of blocks in page order.  Each block has its word
count and link density and those of the blocks next to it, and where it stands
(inside the article, inside a marked surrounding, or neither).  A decision tree
trained on the small labelled table below keeps or drops it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose content is no text of the page; the first few hold raw text, which only an end tag or the page's end closes.
_RAW = "script style textarea iframe"
_SKIPPED = f"{_RAW} noscript template svg object select canvas annotation annotation-xml"
_END = {t: re.compile(rf"</{t}(?=[\s/>])[^<>]*>", re.I) for t in _SKIPPED.split()}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(_END) + r")(?=[\s/>])((?:\"[^\"]*+\"|'[^']*+'|[^'\"<>])*+|[^<>]*)>|<(/?)([a-zA-Z][^\s/<>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\"<>])*+)>|<[!?][^>]*>",
    re.S | re.I,
)
_BLOCKS = set("address article aside blockquote body button center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_PARTS = set("nav header footer aside form head menu dialog button label fieldset legend title".split())
_MAIN = {"article", "main"}
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?|["']""")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b")
#: Words in a class, id or role that mark surroundings; a name counts if each of its parts is one of these or plain layout.
_MARKS = set(
    "ad ads advert advertisement adverts advertising sponsor sponsored sponsors promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer sidebar aside widget widgets related recommended recommendations teaser share sharing cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login search pagination pager toolbar comment comments disqus reply replies respond discussion copyright legal form contentinfo complementary dialog".split()
)
#: Marks of what readers and other pages add, and words that name their authors: together they mark a surrounding as well.
_ADDED = set("comment comments commentlist disqus reply replies respond related recommended recommendations sponsored advert adverts newsletter".split())
_OTHERS = set("post posts user users reader readers visitor visitors member members list lists article articles story stories news thread threads entry entries".split())
_LAYOUT = set("site page global main top bottom left right upper lower primary secondary sticky fixed box bar wrap wrapper container section area region list links block inner outer row col column slot unit item group panel".split())
_SPLIT = re.compile(r"[^a-z]+")

#: The labelled table: place (1 in the article, -1 outside the article of a page that has one, 0 on pages without),
#: marked surrounding, heading, list item; words and link density of the block, of the one before and the one after
#: (0 where there is none); content or not.  In an article only marked parts go; without one, neighbours decide.
_TABLE = np.array([
    (1, 0, 1, 0, 8, 0.0, 0, 0.0, 40, 0.0, 1), (1, 0, 0, 0, 60, 0.0, 8, 0.0, 45, 0.0, 1), (1, 0, 0, 0, 2, 0.0, 50, 0.0, 60, 0.0, 1), (1, 0, 0, 0, 1, 0.0, 0, 0.0, 0, 0.0, 1),
    (1, 0, 0, 0, 20, 0.0, 20, 0.0, 0, 0.0, 1), (1, 0, 0, 1, 3, 1.0, 3, 1.0, 3, 1.0, 1), (1, 0, 0, 1, 4, 1.0, 4, 1.0, 0, 0.0, 1), (1, 0, 0, 0, 5, 1.0, 40, 0.0, 35, 0.0, 1),
    (1, 0, 1, 0, 3, 0.0, 50, 0.0, 3, 1.0, 1), (1, 0, 0, 0, 30, 0.8, 40, 0.0, 3, 1.0, 1), (1, 0, 0, 1, 7, 0.0, 30, 0.0, 6, 0.0, 1), (1, 0, 0, 0, 4, 0.0, 2, 1.0, 2, 1.0, 1),
    (1, 1, 0, 0, 20, 0.0, 60, 0.0, 50, 0.0, 0), (1, 1, 0, 1, 3, 1.0, 3, 1.0, 3, 1.0, 0), (1, 1, 0, 0, 45, 0.0, 30, 0.0, 25, 0.0, 0), (1, 1, 1, 0, 2, 0.0, 60, 0.0, 30, 0.0, 0),
    (-1, 1, 0, 1, 1, 1.0, 0, 0.0, 1, 1.0, 0), (-1, 1, 0, 0, 12, 0.0, 1, 1.0, 8, 0.0, 0), (-1, 0, 0, 0, 10, 0.0, 1, 1.0, 8, 0.0, 0), (-1, 0, 0, 0, 40, 0.0, 60, 0.0, 10, 0.0, 0),
    (-1, 0, 1, 0, 4, 0.0, 1, 1.0, 9, 0.0, 0), (-1, 0, 0, 1, 5, 0.0, 40, 0.0, 5, 0.0, 0), (-1, 0, 0, 0, 90, 0.0, 0, 0.0, 8, 0.0, 0), (-1, 0, 0, 0, 25, 0.1, 30, 0.0, 0, 0.0, 0),
    (0, 1, 0, 0, 15, 0.0, 0, 0.0, 40, 0.0, 0), (0, 1, 0, 0, 60, 0.0, 40, 0.0, 40, 0.0, 0), (0, 1, 0, 1, 2, 1.0, 2, 1.0, 2, 1.0, 0), (0, 1, 1, 0, 3, 0.0, 5, 0.0, 40, 0.0, 0),
    (0, 0, 0, 0, 60, 0.0, 50, 0.0, 40, 0.0, 1), (0, 0, 0, 0, 30, 0.1, 3, 1.0, 40, 0.0, 1), (0, 0, 0, 0, 18, 0.0, 40, 0.0, 3, 1.0, 1), (0, 0, 0, 0, 22, 0.2, 0, 0.0, 0, 0.0, 1),
    (0, 0, 0, 0, 4, 0.0, 50, 0.0, 45, 0.0, 1), (0, 0, 0, 0, 8, 0.0, 30, 0.0, 28, 0.0, 1), (0, 0, 1, 0, 5, 0.0, 2, 1.0, 40, 0.0, 1), (0, 0, 1, 0, 4, 0.0, 60, 0.0, 50, 0.0, 1),
    (0, 0, 0, 0, 6, 0.0, 6, 0.0, 6, 0.0, 1), (0, 0, 0, 0, 6, 0.0, 0, 0.0, 6, 0.0, 1), (0, 0, 0, 0, 6, 0.0, 6, 0.0, 0, 0.0, 1), (0, 0, 0, 0, 1, 0.0, 0, 0.0, 0, 0.0, 1),
    (0, 0, 0, 0, 20, 0.0, 20, 0.0, 0, 0.0, 1), (0, 0, 1, 0, 2, 0.0, 0, 0.0, 20, 0.0, 1), (0, 0, 0, 0, 2, 0.0, 30, 0.0, 0, 0.0, 1), (0, 0, 0, 0, 3, 0.0, 45, 0.1, 18, 0.0, 1),
    (0, 0, 0, 1, 9, 0.0, 30, 0.0, 8, 0.0, 1), (0, 0, 0, 1, 5, 0.0, 6, 0.0, 0, 0.0, 1), (0, 0, 0, 1, 6, 0.4, 7, 0.0, 9, 0.0, 1), (0, 0, 0, 0, 12, 0.0, 2, 1.0, 50, 0.0, 1),
    (0, 0, 0, 0, 5, 1.0, 40, 0.0, 35, 0.0, 1), (0, 0, 0, 0, 12, 0.6, 40, 0.0, 30, 0.0, 1), (0, 0, 1, 0, 6, 1.0, 0, 0.0, 40, 0.0, 1), (0, 0, 0, 0, 25, 0.0, 2, 1.0, 2, 1.0, 1),
    (0, 0, 1, 0, 3, 0.0, 50, 0.0, 3, 1.0, 0), (0, 0, 1, 0, 2, 0.0, 3, 1.0, 3, 1.0, 0), (0, 0, 0, 1, 3, 1.0, 3, 1.0, 3, 1.0, 0), (0, 0, 0, 1, 2, 1.0, 0, 0.0, 2, 1.0, 0),
    (0, 0, 0, 1, 4, 1.0, 3, 0.0, 4, 1.0, 0), (0, 0, 0, 1, 4, 1.0, 4, 1.0, 30, 0.0, 0), (0, 0, 0, 1, 4, 1.0, 4, 1.0, 0, 0.0, 0), (0, 0, 0, 0, 5, 1.0, 2, 1.0, 4, 1.0, 0),
    (0, 0, 0, 0, 6, 0.0, 2, 1.0, 2, 1.0, 0), (0, 0, 0, 0, 30, 0.8, 40, 0.0, 3, 1.0, 0), (0, 0, 0, 0, 3, 0.0, 0, 0.0, 2, 1.0, 0), (0, 0, 0, 0, 45, 0.6, 20, 0.9, 20, 0.9, 0),
    (0, 0, 0, 0, 5, 1.0, 3, 1.0, 0, 0.0, 0), (0, 0, 0, 0, 4, 0.0, 3, 1.0, 0, 0.0, 0), (0, 0, 0, 0, 4, 1.0, 0, 0.0, 4, 1.0, 0), (0, 0, 0, 0, 8, 0.9, 50, 0.0, 6, 0.9, 0),
])


class DecisionTree:
    """A binary classification tree on numeric columns, split by Gini impurity until pure."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8):
        self.root = self._split(x, y, depth)

    def _split(self, x, y, depth):
        if depth == 0 or y.min() == y.max():
            return bool(2 * y.sum() >= len(y))
        best = None
        for f in range(x.shape[1]):
            u = np.unique(x[:, f])
            for at in (u[1:] + u[:-1]) / 2:
                low = x[:, f] <= at
                p, q = y[low].mean(), y[~low].mean()
                cost = low.sum() * p * (1 - p) + (~low).sum() * q * (1 - q)
                if best is None or cost < best[0] - 1e-12:
                    best = cost, f, at
        if best is None:
            return bool(2 * y.sum() >= len(y))
        low = x[:, best[1]] <= best[2]
        return best[1], float(best[2]), self._split(x[low], y[low], depth - 1), self._split(x[~low], y[~low], depth - 1)

    def __call__(self, row) -> bool:
        node = self.root
        while not isinstance(node, bool):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node


TREE = DecisionTree(_TABLE[:, :-1], _TABLE[:, -1])


def _marks(words: list[str]) -> bool:
    """Whether a name's words mark a surrounding: at least one does, and all are marks or plain layout."""
    own = [w for w in words if w not in _LAYOUT]
    if any(w in _ADDED for w in own):
        own = [w for w in own if w not in _OTHERS]
    return bool(own) and all(w in _MARKS or w in _ADDED for w in own)


def _marked(tag: str, attrs: str) -> bool:
    """Whether a tag's name or its attributes say that it is a surrounding or unseen; never for a whole page."""
    if tag in _PARTS:
        return True
    if tag in ("html", "body") or not attrs.strip():
        return False
    for m in _ATTRIBUTE.finditer(attrs):
        name = (m[1] or "").lower()
        if name not in ("hidden", "aria-hidden", "style", "class", "id", "role"):
            continue
        value = html.unescape(m[2] or m[3] or m[4] or "").lower()
        if name == "hidden":
            found = value.strip() != "false"
        elif name == "aria-hidden":
            found = value.strip() == "true"
        elif name == "style":
            found = _UNSEEN.search(value) is not None
        else:
            names = [[w for w in _SPLIT.split(n) if w] for n in value.split()]
            found = any(_marks(n) for n in names)
        if found:
            return True
    return False


def text_blocks(page: str) -> list[tuple[str, int, bool, bool, bool, float]]:
    """Blocks of a page in order: text, in article, marked, heading, list item, link density."""
    blocks = []
    stack: list[tuple[str, bool, bool, bool]] = []  # tag, marked, in article, below what is never part of an article; as inherited
    places: dict[str, list[int]] = {}  # where each tag is on the stack
    parts: list[tuple[str, bool]] = []
    links = 0
    heading = item = False

    def flush():
        nonlocal parts
        text = "".join(t for t, _ in parts)
        words = html.unescape(text).split()
        if words:
            linked = len(html.unescape(" ".join(t for t, a in parts if a)).split())
            marked, main = stack[-1][1:3] if stack else (False, False)
            blocks.append((" ".join(words), main, marked, heading, item, min(1.0, linked / len(words))))
        parts = []

    def push(tag, marked, main):
        outside = bool(stack) and stack[-1][3] or tag not in ("nav", "header", "head") and (marked or tag in ("aside", "footer", "form"))
        places.setdefault(tag, []).append(len(stack))
        stack.append((tag, marked, main, outside))

    def pop():
        places[stack.pop()[0]].pop()

    def open_(tag, attrs):
        marked, main = stack[-1][1:3] if stack else (False, False)
        own = _marked(tag, attrs)
        if tag in _MAIN and not own:
            marked = marked and stack[-1][3]
            main = True
        push(tag, marked or own, main)

    def close(tag):
        """Ends the innermost element of that name, if there is one; every step but one takes an element off."""
        at = places.get(tag)
        if not at or tag in ("p", "li", "div", "td") and any(places.get(t) and places[t][-1] > at[-1] for t in _MAIN):
            return  # a stray end tag does not end the article
        for _ in range(len(stack) - at[-1]):
            pop()

    at = 0
    unclosed: set[str] = set()  # skipped elements that have no end tag in the rest of the page
    last = page.rfind(">") + 1  # beyond it there are no tags, and a comment goes on to the end
    while m := _TOKEN.search(page, at, last) or (_TOKEN.match(page, start) if (start := page.find("<!--", at)) >= 0 else None):
        if m.start() > at:
            parts.append((page[at : m.start()], links > 0))
        at = m.end()
        if m[1] is not None:
            tag = m[1].lower()
            if m[2].endswith("/"):
                continue
            end = None if tag in unclosed else _END[tag].search(page, at)
            if end is not None:
                at = end.end()
            elif tag in _RAW.split():
                at = len(page)
            else:
                unclosed.add(tag)
            continue
        tag = m[4]
        if tag is None:
            continue
        tag, ending, attrs = tag.lower(), bool(m[3]), m[5]
        if tag == "a":
            links = 0 if ending else 1
        elif tag == "br":
            parts.append((" ", False))
        elif tag in _BLOCKS:
            flush()
            links = 0
            if ending:
                close(tag)
                heading, item = False, any(x[0] == "li" for x in stack[-3:])
                continue
            if stack and stack[-1][0] == "p":
                pop()
            if tag in ("li", "td", "th", "tr", "dd", "dt") and stack and stack[-1][0] == tag:
                pop()
            if tag == "body":
                while stack and stack[-1][0] != "html":
                    pop()
            if tag not in _VOID:
                open_(tag, attrs)
                if tag in _HEADINGS and len(stack) > 1 and stack[-2][0] == "header" and stack[-2][2]:
                    stack[-1] = (tag, False, True, stack[-2][3])  # the headline of an article's own header
            heading, item = tag in _HEADINGS, tag == "li"
        elif not ending and tag not in _VOID and attrs.strip() and not attrs.endswith("/") and _marked(tag, attrs):
            flush()
            push(tag, True, stack[-1][2] if stack else False)
        elif ending and stack and stack[-1][0] == tag:
            flush()
            pop()
    if at < len(page):
        parts.append((page[at:], links > 0))
    flush()
    return blocks


def main_text(page: str) -> str:
    """The kept blocks of a page, joined by single spaces; empty if none."""
    blocks = text_blocks(page)
    has_main = any(b[1] and not b[2] for b in blocks)
    size = [(0, 0.0), *((b[0].count(" ") + 1, b[5]) for b in blocks), (0, 0.0)]
    kept = []
    for k, (text, main, marked, heading, item, _) in enumerate(blocks, 1):
        place = (1 if main else -1) if has_main else 0
        if TREE((place, marked, heading, item, *size[k], *size[k - 1], *size[k + 1])):
            kept.append(text)
    return " ".join(kept)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page, from its whole html.

    A null page counts as empty and has an empty text; unclosed or crossed tags, markup cut short and very
    long pages are read to their end.  Of other columns none is read, whatever its name.  Each row stands alone: no shuffle, one page in memory at a time
    beside its batch.  Repeated rows and null ids stay; an empty table gives no rows.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py() or "") for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(extract, "page_id long, url string, text string, n_chars long")
