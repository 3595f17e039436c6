"""Main text of web pages: boosted trees over DOM nodes, decoded as a hierarchy.

Every element that starts a block, and every block of text, is a node with
statistics of its subtree, its siblings, its place and the words of its
attributes.  Boosted trees estimate which share of a node's text is main
text.  The decoding keeps or drops whole subtrees, or leaves the choice to the
children, at the least total cost of the estimates: a block is never kept in
a dropped ancestor, nor dropped in a kept one.

The trees learn from a bounded sample of SAMPLE pages that carry landmarks
(an ``article`` or ``main`` element), and from pages composed anew from their
paragraphs with containers, menus, adverts, notices, forms, comments and
sidebars of many names, so that the landmarks are only one sign among others.

The text has one line for each block, in page order, with single blanks.
NULL and empty pages have an empty text; repeated rows are read once each; a
table without any landmark is read with a model of composed pages alone.
"""

from __future__ import annotations

import random
import re
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm import boosting
from salesmart.llm.common import by_slice
from salesmart.llm.dom import BLOCK_KIND, MarkedPage, Page, features, node_arrays, sums_below

#: Pages to learn from, bytes of one of them at most, composed pages made of each, seed.
SAMPLE, SAMPLE_BYTES, COMPOSED, SEED = 250, 60_000, 3, 20253
#: Cost of leaving the choice to the children.
SPLIT = 0.5

_LANDMARK = re.compile(r"<(article|main)\b", re.I)
#: Elements that are not main text even inside a landmark.
_NEVER = frozenset((7, 8, 9, 10, 11))  # nav, header, footer, aside, form
_NEVER_WORDS = frozenset((1, 3, 4, 5, 6, 7, 8, 9, 10))


def landmark_labels(page: Page) -> list[float]:
    """1 for blocks inside a landmark and outside what is never main text, else 0; elements get the value at their start."""
    out: list[float] = []
    for k, up in enumerate(page.parent):
        value = out[up] if up >= 0 else 0.0
        if page.kind[k] in (0, 1):
            value = 1.0 if value >= 0 else value
        elif page.kind[k] in _NEVER or _NEVER_WORDS.intersection(page.groups[k]):
            value = -1.0
        out.append(value)
    return [max(v, 0.0) for v in out]


#: Names for composed pages, by part.
_MAIN = ("article", "main", 'div class="content"', 'div id="main-content"', 'section class="post"', 'div class="entry-body"', 'div class="story"', "div", 'div class="c12"', 'div class="x-text"', "article", "section")
_WRAP = ('div class="wrapper"', 'div class="container"', "div", 'div id="page"', "section")
_MENU = ("nav", 'div class="menu"', 'ul class="nav"', 'div id="navigation"', 'div class="breadcrumbs"', "div", 'div role="navigation"')
_HEAD = ("header", 'div class="header"', 'div id="masthead"', 'div class="top-bar"')
_FOOT = ("footer", 'div class="footer"', 'div id="foot"', 'div class="copyright"', "div")
_SIDE = ("aside", 'div class="sidebar"', 'div id="side"', 'div class="widget"', 'div class="related"', 'section class="recommended"')
_NOTE = ('div class="notice"', 'div class="cookie-banner"', 'div id="consent"', 'div role="alert" class="alert"', 'div class="popup"', 'p class="notice"')
_AD = ('div class="ad"', 'div class="advert"', 'div class="ads-top"', 'div id="sponsored"', 'aside class="promo"', 'p class="ad"')
_SHARE = ('div class="share"', 'ul class="social"', 'div class="tags"')
_COMMENTS = ('section class="comments"', 'div id="comments"', 'div class="discussion"', 'ol class="comment-list"', 'div id="disqus_thread"', 'section id="responses" class="replies"')


def compose(rng: random.Random, paragraphs: list[str], others: list[str]) -> str:
    """A page with these paragraphs as main text and other parts made of ``others``."""

    def part(names, inner: str, y: int | None = None) -> str:
        name = rng.choice(names)
        mark = f' data-y="{y}"' if y is not None else ""
        return f"<{name}{mark}>{inner}</{name.split()[0]}>"

    def some(low: int, high: int) -> str:
        words = rng.choice(others).split()
        at = rng.randrange(max(1, len(words) - low))
        return escape(" ".join(words[at : at + rng.randint(low, high)]) or "more")

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{k}">{some(1, 3)}</a></li>' for k in range(n))

    def menu() -> str:
        return part(_MENU, f"<ul>{links(rng.randint(2, 9))}</ul>" if rng.random() < 0.7 else " | ".join(f'<a href="#">{some(1, 2)}</a>' for _ in range(rng.randint(2, 7))), 0)

    def advert() -> str:
        return part(_AD, some(3, 30) if rng.random() < 0.7 else f"<p>{some(5, 40)}</p>", 0)

    def note() -> str:
        return part(_NOTE, f"<p>{some(4, 40)}</p><button>OK</button>" if rng.random() < 0.5 else some(4, 40), 0)

    def form() -> str:
        return f'<form data-y="0"><p>{some(2, 12)}</p><label>{some(1, 2)}</label><input name="q"><button>{some(1, 2)}</button></form>'

    def side() -> str:
        body = f"<h3>{some(1, 4)}</h3><ul>{links(rng.randint(2, 6))}</ul>" if rng.random() < 0.6 else f"<h3>{some(1, 4)}</h3><p>{some(8, 60)}</p>"
        return part(_SIDE, body, 0)

    def comments() -> str:
        box = rng.choice(('div class="comment"', "li", "p", 'article class="comment"'))
        each = "".join(f"<{box}><b>{some(1, 2)}</b> <p>{some(4, 70)}</p></{box.split()[0]}>" if box != "p" else f"<p>{some(4, 70)}</p>" for _ in range(rng.randint(1, 6)))
        return part(_COMMENTS, f"<h2>{some(1, 3)}</h2>{each}", 0)

    body, pieces = [], list(paragraphs)
    if rng.random() < 0.7:
        body.append(f"<h1>{escape(pieces[0][:60])}</h1>")
    for text in pieces:
        kind = rng.random()
        shown = escape(text)
        if kind < 0.06:
            body.append(f"<h2>{escape(text[:50])}</h2>")
        elif kind < 0.1:
            body.append(f"<ul><li>{shown}</li><li>{some(4, 20)}</li></ul>")
        elif kind < 0.13:
            body.append(f"<blockquote><p>{shown}</p></blockquote>")
        elif kind < 0.2:
            body.append(f"<div>{shown}</div>")
        else:
            cut = len(shown) // 2
            body.append(f"<p>{shown}</p>" if rng.random() < 0.8 or "&" in shown else f'<p>{shown[:cut]}<a href="#">{shown[cut : cut + 9]}</a>{shown[cut + 9 :]}')
        if rng.random() < 0.06:
            body.append(rng.choice((advert, note, side, form))())
    if rng.random() < 0.2:
        body.append(part(_SHARE, f"<ul>{links(3)}</ul>", 0))
    if rng.random() < 0.15:
        body.append(comments())
    content = "".join(body)
    if rng.random() < 0.3:
        content = part(("div", 'div class="inner"'), content)
    content = part(_MAIN, content, 1)
    before = [make() for make in (menu, advert, note, lambda: part(_HEAD, f"<h2>{some(1, 4)}</h2>" + (menu() if rng.random() < 0.4 else f"<p>{some(2, 9)}</p>"), 0)) if rng.random() < 0.5]
    after = [make() for make in (comments, side, advert, form, menu, lambda: part(_FOOT, f"&copy; {some(2, 25)}" if rng.random() < 0.5 else f"<p>{some(3, 25)}</p><ul>{links(3)}</ul>", 0)) if rng.random() < 0.5]
    rng.shuffle(before)
    inner = "".join((*before, content, *after))
    for _ in range(rng.randint(0, 2)):
        inner = part(_WRAP, inner)
    return f"<html><head><title>t</title></head><body>{inner}</body></html>"


def _blocks(page: Page, label: list[float]) -> list[str]:
    return [t for t, y in zip(page.text, label) if t and y > 0.5]


def learn(sample: list[str]) -> boosting.Trees:
    """Trees from the sample's landmarks and from pages composed of its paragraphs."""
    rng = random.Random(SEED)
    pages, paragraphs = [], []
    for html in sample:
        page = Page(html)
        page.label = landmark_labels(page)
        own = _blocks(page, page.label)
        if own:
            pages.append(page)
            paragraphs.append(own)
    if not paragraphs:
        words = [f"{a}{b}{c}" for a in "bdfklmn" for b in "aeiou" for c in ("", "r", "st", "nd")]
        paragraphs = [[" ".join(rng.choices(words, k=rng.randint(5, 80))).capitalize() + "." for _ in range(rng.randint(2, 12))] for _ in range(60)]
    others = [t for own in paragraphs for t in own]
    pages += [MarkedPage(compose(rng, own, others)) for own in paragraphs for _ in range(COMPOSED)]
    nodes = node_arrays(pages)
    block = nodes["kind"] == BLOCK_KIND
    length = sums_below(nodes, nodes["length"])
    share = sums_below(nodes, nodes["length"] * nodes["label"] * block) / np.maximum(length, 1)
    some = length > 0
    return boosting.fit(features(nodes)[some], share[some], np.log1p(length[some]))


def decode(nodes: dict[str, np.ndarray], p: np.ndarray) -> np.ndarray:
    """Which blocks are kept: the cheapest choice of kept, dropped and divided subtrees."""
    weight = np.log1p(sums_below(nodes, nodes["length"]))
    p = np.clip(p, 1e-5, 1 - 1e-5)
    keep, drop = sums_below(nodes, -weight * np.log(p)), sums_below(nodes, -weight * np.log(1 - p))
    depth, parent = nodes["depth"], nodes["parent"]
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
    divided = np.zeros(len(p))
    best = np.empty(len(p))
    block = nodes["kind"] == BLOCK_KIND
    for level in reversed(levels):
        best[level] = np.minimum(keep[level], drop[level])
        inner = level[~block[level]]
        best[inner] = np.minimum(best[inner], divided[inner] + SPLIT)
        below = level[parent[level] >= 0]
        np.add.at(divided, parent[below], best[below])
    # from the top: 1 kept, -1 dropped, 0 divided
    choice = np.zeros(len(p), np.int64)
    for level in levels:
        if not len(level):
            continue
        own = np.where(keep[level] < drop[level], 1, -1)
        own[(~block[level]) & (divided[level] + SPLIT < np.minimum(keep[level], drop[level]))] = 0
        above = np.where(parent[level] >= 0, choice[np.maximum(parent[level], 0)], 0)
        choice[level] = np.where(above != 0, above, own)
    return block & (choice == 1)


def sample_pages(pages: DataFrame, html: str = "html") -> list[str]:
    """At most SAMPLE pages with a landmark, spread by their hash: the bounded sample to learn from."""
    column = F.col(f"`{html}`").cast("string")
    some = pages.select(column.alias("html")).where(F.octet_length("html") <= SAMPLE_BYTES).where(F.col("html").rlike("(?i)<(article|main)[ >]"))
    some = some.withColumn("spread", F.xxhash64("html"))
    # first the smallest hashes alone, then only their pages reach the driver
    last = some.select("spread").orderBy("spread").limit(SAMPLE).agg(F.max("spread")).first()[0]
    if last is None:
        return []
    return [r["html"] for r in some.where(F.col("spread") <= last).orderBy("spread", "html").limit(SAMPLE).collect()]


def extract(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``page_id, text``: the main text of every page."""
    model = learn(sample_pages(pages, html))
    docs = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{html}`").cast("string").alias("html"), *((F.col("url"),) if "url" in pages.columns else ()))
    names = [c for c in docs.columns if c != "html"]

    def run(part):
        read = [Page(h) for h in part.column("html").to_pylist()]
        nodes = node_arrays(read)
        kept = decode(nodes, model.probabilities(features(nodes)))
        out, at = [], 0
        for page in read:
            some = kept[at : at + len(page.text)]
            at += len(page.text)
            out.append("\n".join(t for t, k in zip(page.text, some.tolist()) if k))
        return pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(out, pa.string())], [*names, "text"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names) + ", text string"
    return by_slice(docs, run, schema, "html")
