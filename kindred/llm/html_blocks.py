"""Main text of web pages from flat text blocks and a small decision tree.

A page is read once from left to right. Block-level tags end a text block; inline
tags do not. A block has its number of words and the share of them inside links,
the same of the block before and behind it, and three marks of where it stands:
in an ``article`` or ``main``, in a part of the page that its tag, role, class or id
names as something else (menu, footer, advert, notice, form, comments), and
whether it is a heading. A decision tree over these numbers, trained on the
labelled blocks of ``LABELLED``, says which blocks are main text; they are
joined in page order by a line feed.

Defined results: a NULL, empty or text-free page has the empty text; a page without
``article`` or ``main`` is judged by words and links; repeated rows are pages of their own;
a page of any length is read whole, in time linear in it; markup that is never closed
ends with the page; character references are decoded as browsers do, also
without their semicolon; an empty table gives no rows; columns of other names
are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import map_batches

# Names of HTML and words that pages use for their parts.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
#: Their content is no text of the page.
SILENT = frozenset("script style noscript template svg math iframe object head title select textarea canvas audio video noframes".split())
#: Content that has no tags inside.
RAW = frozenset("script style textarea title noframes iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARTS = frozenset("nav header footer aside form dialog menu button fieldset search".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
PART_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu breadcrumb breadcrumbs "
    "pagination pager sidebar aside widget footer comment comments reply replies discussion disqus share sharing social related recommended "
    "toolbar skip".split()
)
#: Tags that a new one of the same group closes, as browsers do.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BLOCK_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol pre section table ul".split())

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"  # a comment
    r"|<[!?][^>]*+(?:>|\Z)"  # a declaration
    r"""|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""(?:^|[\s/"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?(?=[\s/"']|$)""", re.I)
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: Inline tags open at once; further ones are not followed, as they mark nothing new.
MOST_INLINE = 512

#: Labelled blocks by page: where it stands ("a" article, "p" another part, "h" heading), words, words in links, main text or not.
LABELLED: list[list[tuple[str, int, int, int]]] = [
    [("p", 1, 1, 0), ("p", 2, 2, 0), ("p", 1, 1, 0), ("p", 8, 0, 0), ("ah", 6, 0, 1), ("a", 1, 0, 1), ("a", 60, 0, 1), ("a", 3, 0, 1), ("a", 140, 2, 1), ("p", 9, 0, 0)],
    [("p", 3, 3, 0), ("ah", 4, 0, 1), ("a", 25, 0, 1), ("ap", 12, 0, 0), ("a", 80, 0, 1), ("ap", 30, 4, 0), ("a", 2, 0, 1), ("ap", 90, 0, 0), ("p", 12, 5, 0)],
    [("p", 40, 0, 0), ("p", 2, 2, 0), ("ah", 9, 9, 1), ("a", 12, 12, 1), ("a", 30, 1, 1), ("a", 1, 1, 1), ("a", 5, 0, 1), ("p", 60, 2, 0), ("p", 120, 0, 0)],
    [("", 2, 2, 0), ("", 1, 1, 0), ("", 3, 3, 0), ("h", 7, 0, 1), ("", 45, 0, 1), ("", 110, 3, 1), ("", 14, 0, 1), ("", 70, 0, 1), ("", 4, 0, 0), ("", 6, 6, 0)],
    [("", 5, 5, 0), ("", 4, 2, 0), ("", 20, 0, 1), ("", 95, 1, 1), ("", 33, 0, 1), ("", 3, 3, 0), ("", 2, 2, 0), ("", 9, 7, 0), ("p", 50, 0, 0), ("", 12, 10, 0)],
    [("h", 2, 2, 0), ("", 6, 6, 0), ("", 18, 15, 0), ("", 22, 18, 0), ("", 3, 3, 0), ("p", 5, 0, 0), ("p", 25, 0, 0)],
    [("p", 15, 15, 0), ("h", 5, 0, 1), ("", 28, 0, 1), ("", 11, 0, 1), ("", 52, 0, 1), ("p", 35, 1, 0), ("", 3, 0, 0)],
    [("", 180, 0, 1)],
    [("", 2, 0, 0)],
    [("a", 2, 0, 1)],
    [("a", 4, 4, 1), ("a", 200, 0, 1), ("ap", 1, 1, 0), ("ap", 2, 2, 0), ("ap", 150, 0, 0)],
    [("p", 200, 0, 0), ("a", 40, 10, 1), ("p", 7, 1, 0)],
]
DEPTH = 6


class Block:
    """A run of text between block-level tags."""

    __slots__ = ("article", "heading", "links", "part", "text", "words")

    def __init__(self, text: str, words: int, links: int, article: bool, part: bool, heading: bool):
        self.text, self.words, self.links, self.article, self.part, self.heading = text, words, links, article, part, heading


def other_part(name: str, rest: str) -> bool:
    """Does a tag open a part of the page that is no main text, or is not shown?"""
    if name in PARTS:
        return True
    if not rest or name in ARTICLE or name in ("html", "body"):
        return False
    for key, *values in ATTRIBUTE.findall(rest):
        key, value = key.lower(), "".join(values)
        if key in ("class", "id"):
            if not PART_WORDS.isdisjoint(w.lower() for w in NAME_WORD.findall(value)):
                return True
        elif key == "role":
            if value.lower() in ROLES:
                return True
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and UNSEEN.search(value)):
            return True
    return False


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page, in order."""
    out: list[Block] = []
    # Open tags: name, in an article, in another part, silent, heading, link.
    stack: list[tuple[str, bool, bool, bool, bool, bool]] = []
    now = ("", False, False, False, False, False)
    open_tags: Counter[str] = Counter()
    inline = 0
    pieces: list[tuple[str, bool]] = []

    def flush() -> None:
        if not pieces:
            return
        text = " ".join(entities.unescape("".join([p for p, _ in pieces])).split())
        if text:
            links = sum(len(entities.unescape(p).split()) for p, linked in pieces if linked)
            out.append(Block(text, text.count(" ") + 1, links, now[1], now[2], now[4]))
        pieces.clear()

    def close_to(depth: int) -> None:
        nonlocal now, inline
        for name, *_ in stack[depth:]:
            open_tags[name] -= 1
            inline -= name in INLINE
        del stack[depth:]
        now = stack[-1] if stack else ("", False, False, False, False, False)

    page, at = page or "", 0
    while True:
        found = TOKEN.search(page, at)
        text = page[at : found.start() if found else len(page)]
        if text and not now[3]:
            pieces.append((text, now[5]))
        if not found:
            break
        at = found.end()
        name = found["name"]
        if name is None:
            continue
        name = name.lower()
        if name not in INLINE:
            flush()
        if found["end"]:
            if not open_tags[name]:
                continue
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    close_to(depth)
                    break
                # An end tag of something inline closes nothing beyond its block.
                if name in INLINE and stack[depth][0] not in INLINE:
                    break
            continue
        rest = found["rest"]
        if name in VOID or rest.endswith("/") and name not in RAW:
            continue
        if name in RAW:
            end = re.compile(f"</{name}(?=[\\s/>]|$)", re.I).search(page, at)
            if name not in SILENT and not now[3]:
                pieces.append((page[at : end.start() if end else len(page)], now[5]))
            at = end.end() if end else len(page)
            at = (page.find(">", at) + 1 or len(page)) if end else at
            continue
        closing = ("p",) if name in BLOCK_CLOSES_P else ()
        closing = CLOSES.get(name, closing)
        if any(open_tags[c] for c in closing):
            for depth in range(len(stack) - 1, -1, -1):
                opened = stack[depth][0]
                if opened in closing:
                    close_to(depth)
                    break
                if opened not in INLINE:
                    break
        if name in INLINE:
            if inline >= MOST_INLINE:
                continue
            inline += 1
        _, article, part, silent, heading, link = now
        if name in ARTICLE:
            article = True
        elif name in HEADINGS:
            heading = True
        # The head of an article has its title; the rest of it is not text.
        titled = name in HEADINGS and article and bool(stack) and stack[-1][0] == "header"
        part = (part and not titled) or other_part(name, rest)
        now = (name, article, part, silent or name in SILENT, heading, link or name == "a")
        open_tags[name] += 1
        stack.append(now)
    flush()
    return out


def features(found: list[Block]) -> np.ndarray:
    """Per block: words and link share of it, of the one before and of the one behind; article, other part, heading."""
    n = len(found)
    words = np.array([0, *[b.words for b in found], 0], dtype=float)
    share = np.array([0, *[b.links / b.words for b in found], 0], dtype=float)
    marks = np.array([(b.article, b.part, b.heading) for b in found], dtype=float).reshape(n, 3)
    return np.column_stack([words[1:-1], share[1:-1], words[:-2], share[:-2], words[2:], share[2:], marks])


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled blocks."""
    x, y = [], []
    for page in LABELLED:
        x.append(features([Block("", words, links, "a" in where, "p" in where, "h" in where) for where, words, links, _ in page]))
        y += [label for *_, label in page]
    return np.concatenate(x), np.array(y)


#: A leaf, or feature, threshold, tree up to it and tree above it.
Tree = bool | tuple


def train(x: np.ndarray, y: np.ndarray, depth: int = DEPTH) -> Tree:
    """A decision tree by Gini impurity; of equally good splits the one of the earlier feature and lower threshold."""
    if depth == 0 or y.min() == y.max():
        return bool(2 * y.sum() > len(y))
    choice = None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        cuts = np.flatnonzero(v[1:] > v[:-1]) + 1
        if not len(cuts):
            continue
        left, right = ones[cuts - 1], ones[-1] - ones[cuts - 1]
        below, above = cuts, len(y) - cuts
        impurity = left * (below - left) / below + right * (above - right) / above
        i = int(np.argmin(impurity))
        if choice is None or impurity[i] < choice[0] - 1e-9:
            choice = (impurity[i], f, (v[cuts[i] - 1] + v[cuts[i]]) / 2)
    if choice is None:
        return bool(2 * y.sum() > len(y))
    _, f, cut = choice
    low = x[:, f] <= cut
    return f, float(cut), train(x[low], y[low], depth - 1), train(x[~low], y[~low], depth - 1)


def judge(tree: Tree, row: list[float]) -> bool:
    while not isinstance(tree, bool):
        f, cut, low, high = tree
        tree = low if row[f] <= cut else high
    return tree


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page)
    if not found:
        return ""
    return "\n".join(b.text for b, row in zip(found, features(found).tolist()) if judge(tree, row))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: page_id, url, its main ``text``, and ``n_chars``."""
    tree = train(*labelled())
    kinds = dict(pages.select(page_id, url).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            texts = [main_text(h, tree) for h in batch.column(2).to_pylist()]
            yield {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"))
    return map_batches(rows, run, f"page_id {kinds[page_id]}, url {kinds[url]}, text string, n_chars long")
