"""Main text of web pages: gradient-boosted trees over DOM nodes and hierarchical decoding.

A page is read into its block elements and the text blocks that stand directly in them. Every
element gets features: how much text its subtree holds, how dense in links, tags and sentence
ends it is, its depth, how it compares with its siblings, and tokens of its name and attributes.
Boosted trees turn them into a log-odds of being article text. Decoding takes the page as a
tree: a subtree is kept whole, dropped whole, or divided among its children, whichever scores
best, so that no kept element lies in a dropped one against the better explanation of both.

The trees learn from the pages themselves: on the documented sample of about `SAMPLE`
pages, chosen by hash, elements inside article or main elements are article text, elements inside
navigation, footers, sidebars, forms, adverts and the like are not, and other elements are not
learned from. Each is learned twice, once with its tokens hidden, so that density alone can
decide where a page has no telling names. All pages are decoded, from their whole HTML.

Defined results: null or empty HTML, and pages without article text, give an empty text; broken
and unclosed markup is read as a browser would close it; repeated rows are separate rows; an
empty table gives an empty table; with nothing to learn from, the signs of the tokens decide;
other columns are carried along by `extracted`.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from seriesforge.llm.common import in_batches, table

SAMPLE = 600

# Element names by how a page is read.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template svg math iframe object select button".split())
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section summary table ul".split()
)
SCOPE = set("html body article aside div td th section main nav header footer form li table blockquote figure".split())
# Tokens of names, classes, ids and roles that speak for or against article text.
FOR = set("article main content post entry story articlebody prose".split())
AGAINST = set(
    "nav navigation menu header footer sidebar aside ad ads advert advertisement sponsored promo banner notice cookie consent popup modal "
    "form comment comments reply disqus social share sharing related recommended widget breadcrumb breadcrumbs toolbar subscribe newsletter "
    "login search pagination pager tags masthead complementary contentinfo".split()
)

TAG = re.compile(r"<(?:!--(?:.*?-->|.*\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>|[!?/][^>]*(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
TOKEN = re.compile(r"[a-z]+")


@dataclass
class Page:
    """Block elements in document order, and text blocks (element, text, characters in links)."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    tokens: list[frozenset] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)


_known: dict[str, frozenset] = {}


def tokens_of(tag: str, attributes: str) -> frozenset:
    key = tag + " " + attributes
    got = _known.get(key)
    if got is None:
        found = {tag}
        for m in ATTRIBUTE.finditer(attributes):
            found.update(TOKEN.findall((m[1] or m[2] or m[3] or "").lower()))
        got = frozenset(found)
        if len(key) < 200 and len(_known) < 20_000:
            _known[key] = got
    return got


def read(html: str) -> Page:
    """The page as block elements and blocks; scripts, styles, comments and markup are left out."""
    page = Page(["html"], [-1], [frozenset(["html"])])
    stack = [("html", 0)]  # open elements; an inline one carries the number of its block element
    buffer: list[str] = []
    linked = in_link = 0

    def flush():
        nonlocal linked
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            if text:
                page.blocks.append((stack[-1][1], text, min(linked, len(text))))
            buffer.clear()
            linked = 0

    def close(upto: int):
        nonlocal in_link
        for name, _ in stack[upto:]:
            in_link -= name == "a"
        del stack[upto:]

    at, end = 0, len(html)
    while at < end:
        m = TAG.search(html, at)
        text = html[at : m.start() if m else end]
        if text:
            buffer.append(text)
            if in_link > 0:
                linked += len(text)
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            where = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
            if where:
                if tag not in INLINE:
                    flush()
                elif any(name not in INLINE for name, _ in stack[where + 1 :]):
                    continue
                close(where)
            continue
        if tag in RAW:
            ended = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
            at = ended.end() if ended else end
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                flush()
            continue
        if tag in INLINE:
            stack.append((tag, stack[-1][1]))
            in_link += tag == "a"
            continue
        flush()
        if tag in CLOSES_P or tag == "li":
            wanted = "li" if tag == "li" else "p"
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == wanted:
                    close(k)
                    break
                if stack[k][0] in SCOPE or stack[k][0] in ("ul", "ol"):
                    break
        page.tags.append(tag)
        page.parents.append(stack[-1][1])
        page.tokens.append(tokens_of(tag, m[3]))
        stack.append((tag, len(page.tags) - 1))
    flush()
    return page


FEATURES = 20
HIDDEN = slice(12, 20)  # the token features


def features(page: Page) -> tuple[np.ndarray, np.ndarray]:
    """(elements x FEATURES, characters of text in each subtree)."""
    n = len(page.tags)
    parent = np.array(page.parents)
    chars, links, stops, words, blocks, tags = (np.zeros(n) for _ in range(6))
    for e, text, linked in page.blocks:
        chars[e] += len(text)
        links[e] += linked
        stops[e] += text.count(".") + text.count(",")
        words[e] += text.count(" ") + 1
        blocks[e] += 1
    own = chars.copy()
    tags += 1
    depth, nth, siblings = np.zeros(n), np.zeros(n), np.zeros(n)
    plus, minus = np.zeros(n), np.zeros(n)
    for i in range(n):
        p = parent[i]
        mine = page.tokens[i]
        plus[i], minus[i] = len(mine & FOR), len(mine & AGAINST)
        if p >= 0:
            depth[i] = depth[p] + 1
            nth[i] = siblings[p]
            siblings[p] += 1
    above_plus, above_minus = plus.copy(), minus.copy()
    for i in range(1, n):
        above_plus[i] += above_plus[parent[i]]
        above_minus[i] += above_minus[parent[i]]
    for i in range(n - 1, 0, -1):
        p = parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        stops[p] += stops[i]
        words[p] += words[i]
        blocks[p] += blocks[i]
        tags[p] += tags[i]
    up = np.where(parent >= 0, parent, 0)
    floor = np.maximum(chars, 1)
    name = np.array([page.tags[i][0] == "h" and page.tags[i][1:].isdigit() for i in range(n)], float)
    x = np.column_stack(
        [
            np.log1p(chars), np.log1p(own), links / floor, tags / floor, stops / floor, words / np.maximum(blocks, 1),
            depth, np.arange(n) / n, nth / np.maximum(siblings[up], 1), siblings[up], chars / np.maximum(chars[up], 1),
            chars * siblings[up] / np.maximum(chars[up], 1),
            plus, minus, above_plus, above_minus, plus[up], minus[up], name,
            np.array([t == "p" for t in page.tags], float),
        ]
    )
    return x, chars


def weak_labels(page: Page) -> np.ndarray:
    """1 inside article or main, 0 inside navigation, footers, forms, adverts and the like, else -1."""
    n = len(page.tags)
    out = np.full(n, -1)
    for i in range(1, n):
        p = out[page.parents[i]]
        if page.tokens[i] & AGAINST:
            out[i] = 0
        elif page.tokens[i] & FOR:
            out[i] = 1 if p != 0 else 0
        else:
            out[i] = p
    return out


@dataclass
class Trees:
    """Depth-wise trees: at each node a feature and a threshold, at each leaf a value."""

    base: float
    split: np.ndarray  # trees x (2^depth - 1), features
    at: np.ndarray  # thresholds
    leaf: np.ndarray  # trees x 2^depth

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        for split, at, leaf in zip(self.split, self.at, self.leaf):
            node = np.zeros(len(x), int)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, split[node]] > at[node])
            out += leaf[node - (leaf.size - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32) -> Trees:
    """Logistic gradient boosting with histogram splits and Newton leaves."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
    score = np.full(len(y), base)
    inner = 2**depth - 1
    split, at, leaf = np.zeros((rounds, inner), int), np.full((rounds, inner), np.inf), np.zeros((rounds, inner + 1))
    for r in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(len(y), int)
        for level in range(depth):
            for k in range(2**level - 1, 2 ** (level + 1) - 1):
                inside = np.flatnonzero(node == k)
                best = 1e-6
                if len(inside) >= 20:
                    gs, hs = g[inside].sum(), h[inside].sum()
                    for f, c in enumerate(cuts):
                        if len(c):
                            gl = np.cumsum(np.bincount(binned[inside, f], g[inside], len(c) + 1))[:-1]
                            hl = np.cumsum(np.bincount(binned[inside, f], h[inside], len(c) + 1))[:-1]
                            gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                            j = int(gain.argmax())
                            if gain[j] > best:
                                best, split[r, k], at[r, k] = gain[j], f, c[j]
            node = 2 * node + 1 + (x[np.arange(len(y)), split[r, node]] > at[r, node])
        node -= inner
        gs, hs = np.bincount(node, g, inner + 1), np.bincount(node, h, inner + 1)
        leaf[r] = rate * gs / (hs + 1)
        score += leaf[r, node]
    return Trees(base, split, at, leaf)


def decode(page: Page, log_odds: np.ndarray, chars: np.ndarray, divide: float = 0.5) -> str:
    """Keep, drop or divide every subtree, whichever explains its elements best."""
    n = len(page.tags)
    weight = np.clip(log_odds, -8, 8) * np.log1p(chars)
    own = np.zeros(n, bool)
    for e, _, _ in page.blocks:
        own[e] = True
    whole = weight.copy()  # gain of keeping the whole subtree over dropping it, added up below
    best = np.zeros(n)
    children = np.zeros(n)
    for i in range(n - 1, -1, -1):
        apart = children[i] + (abs(weight[i]) if own[i] else 0.0) - divide
        best[i] = max(whole[i], -whole[i], apart)
        p = page.parents[i]
        if p >= 0:
            whole[p] += whole[i]
            children[p] += best[i]
    kept = np.zeros(n, int)  # 1 keep, -1 drop, 0 divided
    for i in range(n):
        p = page.parents[i]
        if p >= 0 and kept[p]:
            kept[i] = kept[p]
        elif best[i] == whole[i] and whole[i] > 0:
            kept[i] = 1
        elif best[i] == -whole[i]:
            kept[i] = -1
    keep = (kept == 1) | ((kept == 0) & (weight > 0))
    return " ".join(text for e, text, _ in page.blocks if keep[e])


def by_tokens() -> Trees:
    """Where nothing can be learned: the tokens of an element and its ancestors decide."""
    return Trees(-1.0, np.array([[14, 15, 15]]), np.array([[0.5, 0.5, 0.5]]), np.array([[-1.0, -2.0, 3.0, -2.0]]))


def fit(pages: DataFrame, most: int = SAMPLE) -> Trees:
    """Boosted trees from about `most` different pages, those whose hash is under a threshold; only features reach the driver."""
    hashed = pages.filter(F.length("html") > 0).select("html", F.shiftrightunsigned(F.xxhash64("html"), 32).alias("_place"))
    n = hashed.select("_place").distinct().count()
    sample = hashed.filter(F.col("_place") < F.lit((1 << 32) * most // max(most, n))).dropDuplicates(["_place"]).select("html")

    @pandas_udf("binary")
    def rows(htmls: pd.Series) -> pd.Series:
        def one(h):
            page = read(h)
            x, chars = features(page)
            y = weak_labels(page)
            use = (y >= 0) & (chars > 0)
            return np.column_stack([x[use], y[use]]).astype("<f8").tobytes()

        return htmls.map(one)

    got = in_batches(sample).select(rows("html").alias("x"), F.xxhash64("html").alias("h")).toPandas().sort_values("h")
    parts = [np.frombuffer(b, "<f8").reshape(-1, FEATURES + 1) for b in got["x"]]
    data = np.concatenate(parts) if parts else np.zeros((0, FEATURES + 1))
    x, y = data[:, :-1], data[:, -1]
    if not len(y) or y.min() == y.max():
        return by_tokens()
    masked = x.copy()
    masked[:, HIDDEN] = -1.0
    return boost(np.concatenate([x, masked]), np.concatenate([y, y]))


def extracted(pages: DataFrame, trees: Trees) -> DataFrame:
    """`pages` with `text`, the article."""
    sent = pages.sparkSession.sparkContext.broadcast(trees)

    @pandas_udf("string")
    def article(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in parts:
            read_pages = [read(h) for h in htmls]
            both = [features(p) for p in read_pages]
            odds = sent.value.log_odds(np.concatenate([x for x, _ in both])) if both else np.zeros(0)
            texts, at = [], 0
            for page, (x, chars) in zip(read_pages, both):
                texts.append(decode(page, odds[at : at + len(x)], chars))
                at += len(x)
            yield pd.Series(texts, dtype=object)

    return in_batches(pages, 500).withColumn("text", article(F.coalesce(F.col("html").cast("string"), F.lit(""))))


def query(spark, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    out = extracted(pages, fit(pages))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
