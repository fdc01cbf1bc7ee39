"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into blocks at block-level tags. Each block is described by its number of words and its link density, those
of the blocks before and after it, and whether it stands in a content element or in one marked as something else. The tree
is trained on the small labelled table below.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "inside", "marked")

# Labelled blocks. Columns as in FEATURES, then the label (1: main text). Links are densities in percent, ``inside`` is 1 in
# an article or main element, ``marked`` is 1 in navigation, advert, form, comment and the like.
LABELLED = """
1 100 0 0 1 100 0 1 0
6 100 5 100 40 0 0 1 0
10 0 6 100 8 0 0 1 0
35 0 10 0 60 0 0 1 0
120 3 80 0 15 0 0 1 0
12 0 40 0 0 0 0 1 0
9 30 60 0 0 0 0 1 0
30 0 20 0 25 0 0 1 0
45 0 0 0 0 0 0 1 0
60 0 8 0 5 0 0 1 0
90 0 5 0 45 0 0 1 0
150 0 40 0 30 0 0 1 0
12 0 10 0 80 0 0 1 0
5 100 4 100 90 0 0 1 0
40 0 3 0 120 0 0 1 0
20 10 15 0 55 0 0 1 0
9 0 60 0 70 0 0 1 0
3 0 12 0 80 0 1 1 0
25 0 12 0 80 0 1 1 0
140 2 30 0 90 0 1 1 0
15 60 70 0 2 0 1 1 0
2 100 50 0 2 100 1 1 0
9 0 10 0 60 0 1 0 1
1 0 60 0 70 0 1 0 1
3 0 1 0 40 0 1 0 1
4 0 80 0 30 0 1 0 1
14 0 3 0 5 0 1 0 1
12 20 60 0 60 0 1 0 1
30 35 60 0 12 0 1 0 1
70 0 14 0 1 0 1 0 1
90 5 45 0 120 0 1 0 1
250 1 90 0 60 0 1 0 1
2 0 0 0 0 0 1 0 1
8 0 120 0 9 100 1 0 1
55 0 70 0 12 0 1 0 1
8 0 0 0 0 0 1 0 1
8 0 8 0 1 10 1 0 1
5 0 3 0 5 0 1 0 1
1 0 1 0 1 0 1 0 1
13 0 13 0 4 0 1 0 1
10 0 10 0 10 0 1 0 1
12 0 0 0 12 0 1 0 1
2 0 12 0 2 0 1 0 1
6 0 2 0 12 20 1 0 1
11 0 90 0 4 25 1 0 1
9 0 9 0 5 100 1 0 1
3 35 20 0 3 0 1 0 1
5 100 60 0 50 0 1 0 1
7 100 6 100 8 100 1 0 0
5 100 120 0 6 100 1 0 0
9 95 7 100 4 100 1 0 0
4 100 8 100 0 0 1 0 0
3 100 2 100 2 100 0 0 0
1 100 0 0 1 100 0 0 0
6 100 4 100 30 0 0 0 0
4 0 1 100 2 100 0 0 0
10 0 2 100 3 0 0 0 0
8 50 5 0 0 0 0 0 0
7 0 80 0 0 0 0 0 0
6 0 0 0 5 0 0 0 0
12 10 5 100 3 100 0 0 0
18 70 40 0 20 60 0 0 0
30 55 12 100 8 100 0 0 0
8 0 0 0 0 0 0 0 0
8 0 8 0 1 10 0 0 0
5 0 3 0 5 0 0 0 0
1 0 1 0 1 0 0 0 0
12 0 6 100 12 0 0 0 0
2 0 12 0 2 0 0 0 0
14 0 2 100 9 0 0 0 0
10 0 3 100 6 0 0 0 0
11 0 90 0 4 25 0 0 0
9 0 6 100 70 0 0 0 1
12 0 70 0 80 0 0 0 1
40 0 5 0 60 0 0 0 1
28 0 50 0 45 0 0 0 1
65 0 9 0 30 0 0 0 1
110 4 60 0 70 0 0 0 1
24 10 110 0 5 0 0 0 1
200 2 40 0 6 0 0 0 1
60 0 80 0 4 0 0 0 1
45 0 70 0 8 30 0 0 1
38 0 0 0 0 0 0 0 1
150 1 20 0 12 100 0 0 1
33 6 52 0 18 0 0 0 1
75 0 11 100 2 100 0 0 1
12 0 4 100 60 0 1 0 1
8 0 1 100 90 0 1 0 1
3 0 2 100 80 0 1 0 1
60 0 5 100 70 0 1 0 1
200 0 6 100 40 0 1 0 1
150 0 5 100 110 0 1 0 1
35 0 3 100 5 100 1 0 1
25 0 7 100 6 100 1 0 1
14 0 2 100 3 100 1 0 1
90 2 4 100 0 0 1 0 1
18 0 1 100 0 0 1 0 1
6 0 8 100 5 0 1 0 1
4 100 70 0 90 0 1 0 1
2 100 45 0 60 0 1 0 1
7 100 30 0 120 0 1 0 1
9 100 40 0 35 0 1 0 1
6 100 12 0 6 100 1 0 0
120 0 6 100 80 0 0 0 1
60 0 4 100 50 0 0 0 1
35 0 3 100 40 0 0 0 1
200 0 5 100 9 100 0 0 1
6 0 3 100 90 0 0 0 1
12 0 5 100 60 0 0 0 1
4 0 90 0 70 0 0 0 1
3 0 55 0 65 0 0 0 1
12 0 60 0 50 0 0 0 1
6 0 45 0 120 0 0 0 1
15 0 80 0 40 0 0 0 1
18 0 33 0 28 0 0 0 1
10 0 40 0 30 0 0 0 1
5 0 30 0 150 0 0 0 1
20 0 120 0 60 0 0 0 1
8 0 60 0 9 0 0 0 1
9 0 8 0 10 0 0 0 1
10 0 9 0 70 0 0 0 1
5 0 0 0 80 0 0 0 1
9 0 0 0 60 0 0 0 1
5 100 60 0 70 0 0 0 1
3 100 90 0 45 0 0 0 1
5 100 3 100 60 0 0 0 0
2 100 1 100 120 0 0 0 0
7 100 9 100 45 0 0 0 0
10 90 12 100 80 0 0 0 0
25 80 6 100 40 0 0 0 0
4 100 0 0 6 100 0 0 0
3 100 4 100 5 100 0 0 0
9 75 3 100 35 0 0 0 0
6 100 0 0 90 0 0 0 0
16 60 5 80 150 0 0 0 0
5 100 7 100 6 100 1 0 0
3 100 4 100 0 0 1 0 0
30 50 60 0 40 0 1 0 1
16 0 80 0 0 0 0 0 1
14 0 90 0 4 0 0 0 1
13 0 60 0 7 0 0 0 1
18 0 40 0 2 100 0 0 1
70 0 6 100 12 0 0 0 1
40 0 4 100 8 100 0 0 1
26 0 5 100 14 0 0 0 1
"""

_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead title tr ul caption legend option select button textarea".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CONTENT = frozenset(("article", "main"))
_OTHER = frozenset("nav aside footer form head title select button textarea dialog menu".split())
#: Elements that hold other blocks; their ends are matched with their starts.
_HOLDERS = _CONTENT | _OTHER | frozenset("header div section ul ol dl table figure details blockquote body span".split())
_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments complementary consent contentinfo "
    "cookie cookies copyright dialog discussion disqus footer form legal login menu modal nav navbar navigation newsletter "
    "notice notices pagination popup promo promoted promotion recommended related respond search share sharing sidebar "
    "signup social sponsor sponsored subscribe toolbar widget alert aside advertising".split()
)
_RAW = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|iframe|object|svg)\b[^>]*>.*?(?:</\1\s*>|\Z)|<!\[CDATA\[|<[!?][^>]*>",
    re.S | re.I,
)
#: A quote opens a value only right after the ``=`` of an attribute.
_TAG = re.compile(
    r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+)*+)>"""
)
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+))?+)?+""")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
#: Words that make a class name speak of a state or of something else on the page (``has-sidebar``, ``search-open``).
_STATES = frozenset(
    "has is no not with without show hide hidden open opened closed active enabled disabled visible left right".split()
)
#: Names of :data:`_NAMES` too general to say by themselves, after another word, what an element is (``text-widget``).
_GENERAL = frozenset("widget form notice alert search dialog legal share social related recommended respond aside".split())
#: After one of :data:`_NAMES` these are parts of the same thing (``ad-slot``, ``comment-list``).
_PARTS = frozenset(
    "slot list links link items item box block container wrapper wrap area section panel inner bar button buttons posts "
    "articles main top bottom unit text notice banner form".split()
)


class Block(NamedTuple):
    text: str
    links: int
    inside: int
    marked: int


def _named(token: str) -> str:
    """Which of :data:`_NAMES`, or ``header``, a class, id or role says an element is; empty if none."""
    words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())
    if not words or not _STATES.isdisjoint(words[1:] if len(words) == 1 else words):
        return ""
    last = words[-1]
    if last == "header" or (last in _NAMES and (len(words) == 1 or last not in _GENERAL)):
        return last
    return words[0] if words[0] in _NAMES and last in _PARTS else ""


def _is_marked(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element holds something else than main text. What the body, a main or an article is called says nothing
    about its text."""
    if tag in _OTHER or (tag == "header" and not inside):
        return True
    if tag == "body" or not attributes.strip():
        return False
    has: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(attributes):
        has.setdefault(name.lower(), html.unescape("".join(values)))
    if has.get("hidden", "false").strip().lower() != "false" or has.get("aria-hidden", "").strip().lower() == "true":
        return True
    if _UNSEEN.search(has.get("style", "")):
        return True
    if tag in _CONTENT:
        return False
    names = {_named(token) for key in ("class", "id", "role") for token in has.get(key, "").split()}
    return bool(names & _NAMES) or (not inside and "header" in names)


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, with references decoded and white space made one space."""
    page = _RAW.sub(" ", page)
    found: list[Block] = []
    parts: list[str] = []
    open_: list[tuple[str, bool, bool]] = []
    in_link = 0
    link_words = 0
    at = 0

    def add(raw: str) -> None:
        nonlocal link_words
        text = html.unescape(raw)
        if in_link:
            link_words += len(text.split())
        parts.append(text)

    def flush() -> None:
        nonlocal link_words
        text = " ".join("".join(parts).split())
        if text:
            inside, marked = (open_[-1][1], open_[-1][2]) if open_ else (False, False)
            found.append(Block(text, link_words, int(inside), int(marked)))
        parts.clear()
        link_words = 0

    for tag in _TAG.finditer(page):
        if tag.start() > at:
            add(page[at:tag.start()])
        at = tag.end()
        closing, name, attributes = tag.group(1), tag.group(2).lower(), tag.group(3)
        if name == "a":
            in_link = 0 if closing else 1
        if name in _BLOCKS:
            flush()
        elif name == "br":
            parts.append(" ")
        if name in _HOLDERS and name not in _VOID:
            if not closing:
                inside, marked = (open_[-1][1], open_[-1][2]) if open_ else (False, False)
                marked = marked or _is_marked(name, attributes, inside)
                if name == "span" and marked and not (open_ and open_[-1][2]):
                    flush()
                open_.append((name, inside or name in _CONTENT, marked))
            elif any(o[0] == name for o in open_):
                if name == "span" and open_[-1][0] == "span" and open_[-1][2]:
                    flush()
                while open_.pop()[0] != name:
                    pass
    if at < len(page):
        add(page[at:])
    flush()
    return found


def described(found: list[Block]) -> list[tuple[float, ...]]:
    """The features of every block, see :data:`FEATURES`."""
    sizes = [len(b.text.split()) for b in found]
    density = [100.0 * b.links / n for b, n in zip(found, sizes)]
    words, links = [0, *sizes, 0], [0.0, *density, 0.0]
    return [
        (words[k + 1], links[k + 1], words[k], links[k], words[k + 2], links[k + 2], b.inside, b.marked)
        for k, b in enumerate(found)
    ]


class Tree(NamedTuple):
    """A node asks whether ``feature <= limit``; a leaf has a label only."""

    label: int
    feature: int = -1
    limit: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def classify(self, row: tuple[float, ...]) -> int:
        node = self
        while node.low is not None:
            node = node.low if row[node.feature] <= node.limit else node.high
        return node.label


def train(rows: list[tuple[float, ...]], depth: int = 8, least: int = 2) -> Tree:
    """A tree grown by Gini impurity on rows whose last value is the label, no leaf below ``least`` rows; of equal splits
    the first feature wins."""
    labels = [r[-1] for r in rows]
    label = int(2 * sum(labels) >= len(labels))
    if depth == 0 or len(set(labels)) < 2:
        return Tree(label)

    def impurity(part: list[float]) -> float:
        ones = sum(part)
        return 2 * ones * (len(part) - ones) / len(part)

    best: tuple | None = None
    for feature in range(len(rows[0]) - 1):
        values = sorted({r[feature] for r in rows})
        for a, b in zip(values, values[1:]):
            limit = (a + b) / 2
            low = [r[-1] for r in rows if r[feature] <= limit]
            high = [r[-1] for r in rows if r[feature] > limit]
            if min(len(low), len(high)) < least:
                continue
            cost = impurity(low) + impurity(high)
            if best is None or cost < best[0] - 1e-9:
                best = (cost, feature, limit)
    if best is None:
        return Tree(label)
    _, feature, limit = best
    return Tree(
        label, feature, limit, train([r for r in rows if r[feature] <= limit], depth - 1, least),
        train([r for r in rows if r[feature] > limit], depth - 1, least),
    )


def labelled_table() -> list[tuple[float, ...]]:
    return [tuple(float(x) for x in line.split()) for line in LABELLED.strip().splitlines()]


def main_text(page: str | None, tree: Tree) -> str:
    """The blocks that the tree takes for main text, one per line."""
    found = blocks(page or "")
    return "\n".join(b.text for b, row in zip(found, described(found)) if tree.classify(row))


def extract(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``; null html has no text, repeated rows stay."""
    tree = tree or train(labelled_table())

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(p, tree) for p in batch], dtype=object)

    return pages.select("page_id", "url", text_of("html").alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )
