"""A small reader of web pages: elements, blocks of text, and their statistics."""

from __future__ import annotations

import re
from html import unescape

import numpy as np

#: Fixed names of HTML: elements without content, elements whose text is not shown or is markup or form
#: controls, elements that start a new block, and what closes an open p or an open element of the same kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noframes xmp svg math object canvas".split())
UNSEEN = frozenset("head select button option label datalist map audio video".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table caption tbody td tfoot th thead tr ul".split()
)
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "table tr"), "th": ("td th", "table tr")}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""",
    re.S,
)
# a quote that is never closed ends with its tag: the second form takes such tags
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_BLANKS = re.compile(r"\s+")
#: Unread elements that hold text and no markup; what may hold blocks inside a drawing or formula.
_PLAIN = frozenset("script style textarea title xmp iframe noframes".split())
_EMBEDS = frozenset("foreignobject desc annotation-xml annotation".split())
_TAGS = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_DIGITS = re.compile(r"[0-9]+")
_MARK = re.compile(r'\bdata-y="([01])"')
_RAW_END = {name: re.compile(rf"</{name}\b", re.I) for name in RAW}

#: Kinds of elements, and of words in class, id and role, that the statistics tell apart (by part of a word).
KINDS = ("article", "main", "section", "div", "p", "heading", "list", "nav", "header", "footer", "aside", "form", "table", "quote", "block", "other")
_KIND = {"article": 0, "main": 1, "section": 2, "div": 3, "p": 4, "nav": 7, "header": 8, "footer": 9, "aside": 10, "form": 11, "fieldset": 11, "blockquote": 13, "pre": 13, "figure": 13, "figcaption": 13}
_KIND |= dict.fromkeys(("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"), 5) | dict.fromkeys(("ul", "ol", "li", "dl", "dt", "dd", "menu", "dir"), 6) | dict.fromkeys(("table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"), 12)
BLOCK_KIND, OTHER_KIND = 14, 15
WORDS = (
    r"article|content|\bpost|entry|story|main|\bbody|\btext|prose",
    r"\bnav|menu|breadcrumb|\btoc\b|pagination|pager|tabs",
    r"header|masthead|\btop-?bar|\blogo|\bbrand",
    r"footer|\bfoot\b|copyright|colophon|legal",
    r"side-?bar|\baside|\bside\b|\brail\b|widget",
    r"\bads?\b|\bad[-_s]|[-_]ads?\b|advert|sponsor|promo|banner|adsense",
    r"notice|cookie|consent|alert|gdpr|popup|modal|overlay|toast|warning",
    r"share|social|follow|tweet|\blike",
    r"comment|discuss|repl(y|ies)|disqus|respond|feedback",
    r"form|login|sign-?(up|in)|subscri|newsletter|search|register",
    r"related|recommend|more-|trending|popular|read-?next|teaser|tags?\b",
)
_WORDS = [re.compile(w) for w in WORDS]
_known: dict[str, tuple[int, ...]] = {}


def word_groups(attributes: str) -> tuple[int, ...]:
    """Groups of WORDS in the class, id and role of a tag."""
    if not attributes or "=" not in attributes:
        return ()
    found = []
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            found.append(a or b or c)
    text = " ".join(found).lower()
    if not text:
        return ()
    groups = _known.get(text)
    if groups is None:
        if len(_known) > 50_000:
            _known.clear()
        groups = _known[text] = tuple(k for k, w in enumerate(_WORDS) if w.search(text))
    return groups


def _raw_end(html: str, name: str, at: int, around: set[str]) -> int:
    """Where reading goes on after the start tag of an unread element that ends at ``at``.

    Elements of plain text run to their end tag, or to the end of the page.
    The others hold markup: without an end tag, or where what is around them
    ends first (or a block begins, in a drawing or formula), the start tag
    stands alone and nothing is left out.
    """
    end = _RAW_END[name].search(html, at)
    close = html.find(">", end.end()) if end else -1
    if name in _PLAIN:
        return close + 1 if close >= 0 else len(html)
    if close < 0:
        return at
    opened: dict[str, int] = {}
    embeds = False
    for ending, tag in _TAGS.findall(html, at, end.start()):
        tag = tag.lower()
        embeds |= tag in _EMBEDS
        if ending and tag in around and not opened.get(tag):
            return at
        if name in ("svg", "math") and not embeds and not ending and tag in BLOCK:
            return at
        opened[tag] = opened.get(tag, 0) + (-1 if ending else 1)
    return close + 1


class Page:
    """Nodes in page order: elements that start blocks, and the blocks of text themselves.

    ``parent``, ``depth``, ``kind``, ``groups`` for each node; ``text`` of
    blocks (None for elements), ``linked`` and ``label`` (0, but for training
    pages).
    """

    def __init__(self, html: str | None):
        self.parent, self.depth, self.kind, self.groups, self.text, self.linked, self.label = [], [], [], [], [], [], []
        self._read(html or "")

    def _label(self, attributes: str, above: float) -> float:
        return above

    def _add(self, parent: int, kind: int, groups: tuple[int, ...], text: str | None, linked: int, label: float) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.kind.append(kind)
        self.groups.append(groups)
        self.text.append(text)
        self.linked.append(linked)
        self.label.append(label)
        return len(self.parent) - 1

    def _read(self, html: str) -> None:
        node = self._add(-1, OTHER_KIND, (), None, 0, 0.0)
        # open elements: name, node that holds their text, whether it is their own
        stack: list[tuple[str, int, bool]] = [("", node, True)]
        run: list[str] = []
        linked = links = unseen = 0

        def flush():
            nonlocal run, linked
            if run:
                text = _BLANKS.sub(" ", unescape("".join(run))).strip()
                if text:
                    self._add(node, BLOCK_KIND, (), text, min(linked, len(text)), self.label[node])
            run, linked = [], 0

        def pop(at: int):
            """Close all elements from place ``at`` of the stack."""
            nonlocal node, links, unseen
            if any(own for _, _, own in stack[at:]):
                flush()
            for name, _, _ in stack[at:]:
                links -= name == "a"
                unseen -= name in UNSEEN
            del stack[at:]
            node = stack[-1][1]

        at, size = 0, len(html)
        while at < size:
            found = _TOKEN.search(html, at)
            start = found.start() if found else size
            if start > at and not unseen:
                run.append(html[at:start])
                if links:
                    linked += start - at
            if not found:
                break
            at = found.end()
            name = (found[2] or found[5] or "").lower()
            if not name:
                continue
            if found[1] or found[4]:
                for place in range(len(stack) - 1, 0, -1):
                    if stack[place][0] == name:
                        pop(place)
                        break
                    # an end tag inside a block does not close what is around the block, but for blocks themselves
                    if stack[place][2] and name not in BLOCK:
                        break
                continue
            attributes = found[3] or found[6] or ""
            if name in RAW:
                if not attributes.rstrip().endswith("/"):
                    at = _raw_end(html, name, at, {n for n, _, own in stack if own})
                run.append(" ")
                continue
            if name in VOID:
                if name == "hr":
                    flush()
                else:
                    run.append(" " if name == "br" else "")
                continue
            if name in BLOCK:
                for place in range(len(stack) - 1, 0, -1):
                    other = stack[place][0]
                    if other == "p":
                        pop(place)
                        break
                    if stack[place][2]:
                        break
                if name in CLOSES:
                    ends, stops = CLOSES[name]
                    for place in range(len(stack) - 1, 0, -1):
                        if stack[place][0] in ends:
                            pop(place)
                            if name not in ("tr",):
                                break
                        elif stack[place][0] in stops:
                            break
                flush()
                node = self._add(node, _KIND.get(name, OTHER_KIND), word_groups(attributes), None, 0, self._label(attributes, self.label[node]))
                stack.append((name, node, True))
            else:
                links += name == "a"
                unseen += name in UNSEEN
                stack.append((name, node, False))
        flush()


class MarkedPage(Page):
    """A page composed for training: ``data-y`` is the label of what it marks. Never a page under extraction."""

    def _label(self, attributes: str, above: float) -> float:
        mark = _MARK.search(attributes)
        return float(mark[1]) if mark else above


GROUPS, KIND_COUNT = len(WORDS), len(KINDS)
#: Kinds whose presence above a node is told.
_ABOVE = (0, 1, 6, 7, 8, 9, 10, 11, 12)
FEATURES = 26 + 2 * GROUPS + KIND_COUNT + len(_ABOVE)


def node_arrays(pages: list[Page]) -> dict[str, np.ndarray]:
    """The nodes of many pages in one numbering."""
    sizes = np.array([len(p.parent) for p in pages])
    base = np.repeat(np.cumsum(sizes) - sizes, sizes)
    parent = np.array([x for p in pages for x in p.parent], np.int64)
    out = {"page": np.repeat(np.arange(len(pages)), sizes), "parent": np.where(parent >= 0, parent + base, -1)}
    for name, kind in (("depth", np.int64), ("kind", np.int64), ("linked", float), ("label", float)):
        out[name] = np.array([x for p in pages for x in getattr(p, name)], kind)
    texts = [x for p in pages for x in p.text]
    out["length"] = np.array([len(t) if t else 0 for t in texts], float)
    out["stops"] = np.array([t.count(". ") + t.count(",") + t.count(".") if t else 0 for t in texts], float)
    out["digits"] = np.array([sum(map(len, _DIGITS.findall(t))) / len(t) if t else 0 for t in texts], float)
    groups = np.zeros((len(parent), GROUPS), bool)
    at = 0
    for p in pages:
        for g in p.groups:
            for k in g:
                groups[at, k] = True
            at += 1
    out["groups"] = groups
    return out


def sums_below(nodes: dict[str, np.ndarray], values: np.ndarray) -> np.ndarray:
    """Per node, the sum of ``values`` over its subtree (levels from the deepest up)."""
    out = values.astype(float).copy()
    depth, parent = nodes["depth"], nodes["parent"]
    order = np.argsort(-depth, kind="stable")
    edges = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, edges):
        if len(level) and depth[level[0]]:
            np.add.at(out, parent[level], out[level])
    return out


def features(nodes: dict[str, np.ndarray]) -> np.ndarray:
    """Statistics of each node: its subtree, its place on the page, its siblings, its own and its ancestors' words."""
    n, parent, page = len(nodes["parent"]), nodes["parent"], nodes["page"]
    block = nodes["kind"] == BLOCK_KIND
    # a root is its own parent, and the one sibling of a group of its own: pages do not meet
    up = np.where(parent >= 0, parent, np.arange(n))
    family = np.where(parent >= 0, parent, n + page)
    length = sums_below(nodes, nodes["length"])
    elements = sums_below(nodes, ~block)
    blocks = sums_below(nodes, block)
    linked = sums_below(nodes, nodes["linked"])
    stops = sums_below(nodes, nodes["stops"])
    in_p = sums_below(nodes, nodes["length"] * (block & (nodes["kind"][up] == 4)))
    paragraphs = sums_below(nodes, nodes["kind"] == 4)
    items = sums_below(nodes, nodes["kind"] == 6)
    heads = sums_below(nodes, nodes["kind"] == 5)
    digits = sums_below(nodes, nodes["digits"] * nodes["length"])
    roots = np.flatnonzero(parent < 0)
    total = length[roots][page]
    # text ahead of a node: all blocks before it in page order
    ahead = np.cumsum(nodes["length"]) - nodes["length"]
    ahead -= ahead[roots][page]
    # siblings in page order
    order = np.lexsort((np.arange(n), family))
    same = np.concatenate(([False], family[order][1:] == family[order][:-1]))
    number = np.zeros(n)
    start = np.flatnonzero(~same)
    count = np.diff(np.concatenate((start, [n])))
    number[order] = np.arange(n) - np.repeat(start, count)
    siblings = np.zeros(n)
    siblings[order] = np.repeat(count, count)
    density = linked / np.maximum(length, 1)
    before, after = np.full((n, 3), -1.0), np.full((n, 3), -1.0)
    about = np.column_stack((np.log1p(length), density, nodes["kind"]))
    pair = np.flatnonzero(same)
    before[order[pair]] = about[order[pair - 1]]
    after[order[pair - 1]] = about[order[pair]]
    alike = np.zeros(n)
    like = np.unique(np.column_stack((family, nodes["kind"])), axis=0, return_inverse=True, return_counts=True)
    alike = like[2][like[1].ravel()] / np.maximum(siblings, 1)
    # what stands above, passed down level by level
    above = np.concatenate((nodes["groups"], np.column_stack([nodes["kind"] == k for k in _ABOVE])), axis=1)
    down = np.argsort(nodes["depth"], kind="stable")
    for level in np.split(down, np.flatnonzero(np.diff(nodes["depth"][down])) + 1):
        inner = level[parent[level] >= 0]
        above[inner] |= above[parent[inner]]
    kinds = np.zeros((n, KIND_COUNT))
    kinds[np.arange(n), nodes["kind"]] = 1
    return np.column_stack([
        nodes["depth"], np.log1p(length), np.log1p(elements), density, np.log1p(length / np.maximum(elements, 1)), stops / np.maximum(length, 1),
        np.log1p(length / np.maximum(blocks, 1)), np.log1p(paragraphs), in_p / np.maximum(length, 1), number / np.maximum(siblings, 1), np.log1p(siblings),
        length / np.maximum(length[up], 1), length / np.maximum(total, 1), ahead / np.maximum(total, 1), (ahead + length) / np.maximum(total, 1),
        np.log1p(items), np.log1p(heads), digits / np.maximum(length, 1), alike, before, after, density[up],
        nodes["groups"], above, kinds,
    ]).astype(np.float32)
