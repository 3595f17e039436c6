import random
import re
from html import unescape

import numpy as np
import numpy as np
import pytest

from salesmart.llm import boosting, extraction
from salesmart.llm.dom import MarkedPage, Page, features, node_arrays, sums_below
from salesmart.llm.queries import QUERIES


def article(html):
    """The text between the article's tags, cut at its blocks' tags."""
    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    parts = (re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " ")))).strip() for p in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(p for p in parts if p)


def read(model, htmls):
    pages = [Page(h) for h in htmls]
    nodes = node_arrays(pages)
    kept, at, out = extraction.decode(nodes, model.probabilities(features(nodes))), 0, []
    for page in pages:
        some = kept[at : at + len(page.text)]
        at += len(page.text)
        out.append("\n".join(t for t, k in zip(page.text, some) if k))
    return out


@pytest.fixture(scope="module")
def sample(spark):
    return extraction.sample_pages(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


@pytest.fixture(scope="module")
def model(sample):
    return extraction.learn(sample)


def test_query_against_the_articles(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op8_boosted_dom"](spark, sf).collect()
    assert len(rows) == len(pages)
    assert {r["page_id"]: r["text"] for r in rows} == {k: article(h) for k, h in pages.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_other_names_and_parts(model, sample):
    """Composed pages that the trees have not seen: nearly all text is told apart."""
    rng = random.Random(7)
    texts = [article(h).split("\n") for h in sample[:150]]
    others = [t for own in texts for t in own]
    extra = missed = total = 0
    for own in texts:
        html = extraction.compose(rng, own, others)
        page = MarkedPage(html)
        want = [t for t, y in zip(page.text, page.label) if t and y > 0.5]
        got = read(model, [re.sub(' data-y="."', "", html)])[0].split("\n")
        extra += sum(len(t) for t in got if t not in want)
        missed += sum(len(t) for t in want if t not in got)
        total += sum(map(len, want))
    assert extra < 0.02 * total and missed < 0.01 * total


def blocks(html):
    return [t for t in Page(html).text if t]


@pytest.mark.parametrize("html, want", [
    (None, []), ("", []), ("plain  text\n", ["plain text"]), ("<p>a<p>b</p></p>c", ["a", "b", "c"]),
    ("<p><b>bold<br>\n x <p>next</b> y", ["bold x", "next y"]),
    ('<script>var t="</p>";</script><style>p{}</style><p>a &lt;b&gt; &amp; &#233; &nbsp; c', ["a <b> & é c"]),
    ("<!-- a <p>b</p> --><p>c<!-- d", ["c"]), ('<p title="a > b">x</p><a href="y>z', ["x", "z"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
    ("<div>a<span>b</span> c<div>d</div>e</div>", ["ab c", "d", "e"]),
    ("a < b and <3 <p>x</p>", ["a < b and <3", "x"]), ("<p>x</div>y</p>", ["xy"]),
    ("<form><label>n</label><input><select><option>o</select><button>b</button>text</form>", ["text"]),
    ("<head><title>t</title></head><body>b", ["b"]), ("<scr", []), ("<p " + "a='" * 3000, []),
])
def test_blocks(html, want):
    assert blocks(html) == want


def test_decoding_does_not_contradict_itself():
    rng = np.random.default_rng(3)
    page = Page("<div><div><p>aa</p><p>bbb</p></div><div><p>c</p>dddd<div>eee<p>f</p></div></div></div>" * 3)
    nodes = node_arrays([page])
    block = np.array([t is not None for t in page.text])
    weight = np.log1p(sums_below(nodes, nodes["length"]))
    for _ in range(30):
        p = rng.random(len(block))
        kept = extraction.decode(nodes, p)

        def best(k, p=p):
            """Least cost and choice of the subtree of k, by trying all three."""
            below = [c for c in range(len(block)) if nodes["parent"][c] == k]
            under = [k]
            for u in under:
                under += [c for c in range(len(block)) if nodes["parent"][c] == u]
            options = [(sum(-weight[u] * np.log(p[u]) for u in under), {u for u in under if block[u]}), (sum(-weight[u] * np.log(1 - p[u]) for u in under), set())]
            if below:
                parts = [best(c) for c in below]
                options.append((sum(c for c, _ in parts) + extraction.SPLIT, set().union(*(s for _, s in parts))))
            return min(options, key=lambda o: o[0])

        assert set(np.flatnonzero(kept)) == best(0)[1]


def test_trees_learn_a_rule():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 5)).astype(np.float32)
    y = ((x[:, 1] > 0.6) ^ (x[:, 3] < 0.3)).astype(float)
    model = boosting.fit(x[:2000], y[:2000], np.ones(2000))
    assert ((model.probabilities(x[2000:]) > 0.5) == y[2000:]).mean() > 0.97


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "v", "<article><p>Some words of a text.</p></article>"), (4, "w", "x" * 200_000), (4, "w", "x" * 200_000), (5, "d", "<div>" * 3000 + "deep")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' AS text", "1 AS label", "2 AS parent")
    got = extraction.extract(pages)
    assert got.columns == ["page_id", "url", "text"] and got.count() == len(rows)
    found = {r["url"]: r["text"] for r in got.collect()}
    assert found["u"] == "" and found[None] == "" and found["v"] == "Some words of a text."
    assert extraction.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("tag", ['div data-year="2020"', 'section data-youtube-id="abc"', 'p data-y="12px"', "div data-y='1'", 'div data-y="1"'])
def test_attributes_of_real_pages_are_no_labels(model, tag):
    html = f"<html><body><{tag}>x</{tag.split()[0]}></body></html>"
    page = Page(html)
    assert [t for t in page.text if t] == ["x"] and set(page.label) == {0.0}
    read(model, [html])


@pytest.mark.parametrize("html, blocks", [
    ("<article><p>a</p><canvas><p>b</p></article><p>c</p>", ["a", "b", "c"]),
    ("<article><p>a</p><svg><path d='M0'/><p>b</p></article><p>c</p>", ["a", "b", "c"]),
    ("<div><p>a</p><svg><path/></div><p>c</p><svg></svg>", ["a", "c"]),
    ("<p>a</p><noscript><p>b</p>", ["a", "b"]), ("<p>a</p><object><p>b", ["a", "b"]), ("<p>a</p><math>x<p>b</p>", ["a", "x", "b"]),
    ("<p>a</p><svg><foreignObject><div>in</div></foreignObject></svg><p>b</p>", ["a", "b"]), ("<p>a</p><canvas>no</canvas><noscript><p>no</p></noscript><p>b</p>", ["a", "b"]),
    ("<p>a</p><script>var x = '<p>b</p>'", ["a"]), ("<p>a</p><textarea><p>b</p>", ["a"]),
])
def test_elements_that_are_never_closed(html, blocks):
    assert [t for t in Page(html).text if t] == blocks


def test_a_page_does_not_depend_on_its_neighbours(sample):
    """Statistics of a page alone, first and last in a slice."""
    pages = [Page(h) for h in [*sample[:6], "<p>bare</p><p>blocks</p>", ""]]
    together = features(node_arrays(pages))
    at = 0
    for page in pages:
        alone = features(node_arrays([page]))
        assert np.array_equal(alone, together[at : at + len(page.text)])
        at += len(page.text)


def test_digits_of_a_long_block_count_whole():
    a, b = (node_arrays([Page(f"<p>{'word ' * 100}{tail}</p>")]) for tail in ("7 " * 2000, "w " * 2000))
    assert a["digits"].max() > 0.4 and b["digits"].max() == 0
