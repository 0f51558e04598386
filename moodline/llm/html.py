"""Main text of web pages: the maximum-scoring subsequence of words and tags.

A page is a sequence of words and tags. Words score by where they stand (plain text, link, or a menu,
notice, advert, form and the like), tags score negative. The contiguous region with the highest sum,
found in one scan, is the main text; what menus, notices and the like it encloses is left out.

Weights are log-odds of standing inside the article, from pages that say themselves where that is by
one <article> or <main> element; a bounded sample of these by the hash of their ids is read whole. The
element serves to learn the weights and is no part of a page's score: the scan decides on every page.

Scripts, styles and comments are no part of the sequence. Character references are decoded once, white
space in a block becomes one space, blocks are joined by line breaks. A page that is null or empty, or has no
region of positive score, has the empty text. Pages are looked at one by one: repeated rows have equal
texts. Without labelled pages the default weights stand. An empty table gives an empty result. Time grows in
proportion to a page, however long and broken it is: a tag ends at the next < or > outside of quotes, and a closing
tag that closes nothing costs one look-up.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 2000  # labelled pages, at most
LIMIT = 2.0  # of a weight
PRIOR = 5.0  # tokens that the default weight counts for

#: Elements by what they mean in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset(
    "aside button canvas dialog footer form head iframe menu nav noscript object select svg textarea title".split()
)
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr br img".split()
)
ARTICLE = frozenset(("article", "main"))
#: Words in class, id and role that name menus, notices, adverts, comments; and those that name content.
NAMES = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright discussion disqus footer gdpr login menu modal nav navbar navigation newsletter notice "
    "notification overlay pager pagination popup promo recommended related replies respond search share sharing "
    "sidebar signup social sponsor sponsored subscribe toolbar widget complementary contentinfo dialog".split()
)
OUTSIDE_ONLY = frozenset("header masthead topbar alert side".split())  # inside an article these are its own
STATES = frozenset("has with without no layout".split())  # say what is beside an element: has-sidebar
CONTENT = frozenset("article body container content entry has layout main page post story text with wrapper".split())

#: Default weights. Words: plain text, links, boilerplate beside an article, others beside it, and
#: boilerplate that the region may enclose, since it is left out anyway.
DEFAULTS = {
    "text": 1.0, "link": -0.5, "boilerplate": -1.5, "within": -0.2,
    "inline": -0.05, "p": -0.05, "heading": -0.05, "list": -0.5, "table": -0.5, "div": -0.5, "other": -0.5,
}
WORDS = ("text", "link", "boilerplate")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template)\b[^<>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>",
    re.S | re.I,
)
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_PARTS = re.compile(r"[^a-z]+")


def _group(name: str) -> str:
    if name in INLINE:
        return "inline"
    if name == "p":
        return "p"
    if len(name) == 2 and name[0] == "h" and name[1].isdigit():
        return "heading"
    if name in ("ul", "ol", "li", "dl", "dt", "dd"):
        return "list"
    if name in ("table", "tbody", "thead", "tr", "td", "th"):
        return "table"
    return "div" if name in ("div", "section", "article", "main", "body") else "other"


def _boilerplate(name: str, attributes: str, inside: bool) -> bool:
    if name in BOILERPLATE or (name == "header" and not inside):
        return True
    if not attributes or name in ("html", "body") or name in ARTICLE and not inside:
        return False
    if _HIDDEN.search(attributes):
        return True
    names = [set(_PARTS.split(n)) for _, v in _NAMED.findall(attributes) for n in v.lower().split()]
    if any(n & NAMES and not n & STATES for n in names):
        return True
    parts = set().union(*names)
    return not inside and not parts & CONTENT and bool(parts & OUTSIDE_ONLY)


@dataclass
class Token:
    """A tag, or the text between two; ``inside`` an article, ``kept`` if no boilerplate holds it."""

    kind: str
    text: str
    count: int
    inside: bool
    kept: bool


def tokens(page: str) -> list[Token]:
    out: list[Token] = []
    stack: list[tuple[str, bool, bool]] = []  # name, boilerplate, article
    opened: Counter = Counter()  # names in the stack: most stray closing tags have none
    dropped = articles = links = 0

    def pop(to: int) -> None:
        nonlocal dropped, articles, links
        while len(stack) > to:
            name, drop, article = stack.pop()
            opened[name] -= 1
            dropped -= drop
            articles -= article
            links -= name == "a"

    def add(text: str) -> None:
        if not text:
            return
        text = entities.unescape(text)
        kind = "boilerplate" if dropped else "link" if links else "text"
        out.append(Token(kind, text, len(text.split()), articles > 0, not dropped))

    at = 0
    for m in _TOKEN.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        name = m[3]
        if name is None:
            continue
        name, closing, attributes = name.lower(), bool(m[2]), m[4]
        block = name not in INLINE
        if name == "body" and not closing:
            pop(0)  # whatever the head left open
        if closing:
            if opened[name] > 0:
                here = len(stack) - 1
                while stack[here][0] != name:
                    here -= 1
                pop(here)
        elif name not in VOID and not attributes.endswith("/"):
            if block or name == "a":
                while stack and stack[-1][0] in ("a", "p", "span"):  # ends that were left out
                    pop(len(stack) - 1)
            drop = _boilerplate(name, attributes, articles > 0)
            # of paragraphs and inline elements only those with a meaning here
            if drop or name == "a" or (block and name not in ("p", "li", "html", "body", "tr", "td", "th", "dt", "dd")):
                stack.append((name, drop, name in ARTICLE))
                opened[name] += 1
                dropped += drop
                articles += name in ARTICLE
                links += name == "a"
        out.append(Token(_group(name), "\n" if block else " " if name == "br" else "", 1, articles > 0, not dropped))
    add(page[at:])
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous region with the highest positive sum, the first if tied."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for k, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += s
        if total > best:
            best, region = total, (start, k + 1)
    return region


def main_text(page: str | None, weights: dict[str, float]) -> str:
    if not page:
        return ""
    found = tokens(page)

    def score(t: Token) -> float:
        if t.kind not in WORDS:
            return weights[t.kind]
        return weights[t.kind if t.kept else "within"] * t.count

    start, end = best_region([score(t) for t in found])
    kept = (t for t in found[start:end] if t.kept)
    blocks = (" ".join(b.split()) for b in _blocks(kept))
    return "\n".join(b for b in blocks if b)


def _blocks(found: Iterator[Token]) -> Iterator[str]:
    block: list[str] = []
    for t in found:
        if t.kind not in WORDS and t.text == "\n":
            yield "".join(block)
            block = []
        else:
            block.append(t.text)
    yield "".join(block)


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> dict[str, float]:
    """Log-odds of each kind of token standing inside the article, held to the side it belongs to."""
    page = F.col(f"`{html_col}`").cast("string")
    labelled = pages.filter(F.regexp_count(page, F.lit(r"(?i)<(?:article|main)\b")) == 1)
    chosen = (
        labelled.select(F.col(f"`{id_col}`").alias("id")).orderBy(F.xxhash64("id"), "id").limit(sample).distinct()
    )
    rows = labelled.select(F.col(f"`{id_col}`").alias("id"), page.alias("page")).join(F.broadcast(chosen), "id")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            seen: Counter = Counter()
            for p in frame["page"]:
                for t in tokens(p or ""):
                    seen[t.kind, t.inside] += t.count
            yield pd.DataFrame([(k, i, n) for (k, i), n in seen.items()], columns=["kind", "inside", "n"])

    counts = rows.select("page").mapInPandas(count, "kind string, inside boolean, n long")
    totals = {(r["kind"], r["inside"]): r["n"] for r in counts.groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect()}
    weights = dict(DEFAULTS)
    for kind, default in DEFAULTS.items():
        n = totals.get((kind, True), 0) + totals.get((kind, False), 0)
        if kind == "within" or not n:
            continue
        share = 1 / (1 + math.exp(-default))
        odds = (totals.get((kind, True), 0) + PRIOR * share) / (totals.get((kind, False), 0) + PRIOR * (1 - share))
        odds = max(-LIMIT, min(LIMIT, math.log(odds)))
        # words of plain text count for the article, tags never
        weights[kind] = max(odds, 0.1) if kind == "text" else min(odds, -0.05)
    return weights


def extract(
    pages: DataFrame,
    weights: dict[str, float],
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    @F.pandas_udf("string")
    def text_of(html: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, weights) for p in html], dtype=object)

    return pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        F.col(f"`{url_col}`").alias("url"),
        text_of(F.col(f"`{html_col}`").cast("string")).alias("text"),
    ).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
