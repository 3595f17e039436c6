import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from salesmart.llm import entities
from salesmart.llm.queries import QUERIES


def plain(text):
    """The fixed patterns, as plainly as they are stated."""
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x.lstrip("0")[:4] or 0) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        double = [x if k % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for k, x in enumerate(reversed(d))]
        if 14 <= len(d) <= 19 and sum(double) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return ",".join(f"{entities.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


@pytest.fixture(scope="module")
def field(spark, sf):
    return entities.train(spark.read.parquet(f"{sf}/documents.parquet"))


def found(field, text):
    return entities.listed(entities.find(field, [text])[0])


def test_query_against_plain_patterns(spark, sf):
    docs = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op11_skip_chain"](spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = plain(docs[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert ",".join(s for s in r["spans"].split(",") if not s.startswith("like")) == want
        for kind in ("email", "ip", "card", "phone"):
            assert r[f"n_{kind}"] == want.count(f"{kind}:")
    assert sum(r["n_like"] for r in rows) == 0  # the tables hold no mention in another format


@pytest.mark.parametrize("text", [
    "a@b.c@d.e @x.y é@a.b a@é.b a@b. a@b.c.", "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1 001.002.003.0004 ٣.1.1.1", "4111 1111-1111 1111 4111  1111", "1" * 40 + " 0" * 15,
    "+1 (017) 555-7713 4736962573099581", "+1 +12 345 678 90- +49.170.1234567.", "++1234567890", "0000000000000000", "", None, "a" * 2000 + "@", "@" * 2000, "1." * 2000, "1 " * 2000, "+1" * 2000,
    "x@" + "a." * 1000, "1.1.1." + "0" * 5000 + "1",
])
def test_fixed_patterns(text):
    assert entities.listed(entities.base(text or "")) == plain(text)


def test_random_strings_against_plain_patterns():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("0123456789 .-+()@a") for _ in range(rng.randrange(60)))
        assert entities.listed(entities.base(text)) == plain(text)


def test_messages_give_exact_marginals_on_trees():
    """Against the sum over all labellings, where the graph has no loop."""
    rng = np.random.default_rng(0)
    field = entities.Field(rng.normal(size=(entities.FEATURES, 5)), rng.normal(size=(3, 5, 5)))
    edges = np.array([[0, 1, 0], [1, 2, 0], [0, 3, 1], [2, 4, 2]])
    none = np.zeros(5, np.int64)
    graph = entities.Graph(none, np.repeat(np.arange(5), 3), rng.integers(0, entities.FEATURES, 15), np.array([0, 3, 0, 0, 2]), none > 0, *edges.T)
    clamp = np.array([False, True, False, False, False])
    node, edge = field.marginals(graph, clamp)
    want, pairs, total = np.zeros((5, 5)), np.zeros((4, 5, 5)), 0
    for labels in itertools.product(range(5), repeat=5):
        if labels[1] != 3:
            continue
        score = sum(field.unary[f, labels[o]] for o, f in zip(graph.owner, graph.feature) if o != 1) + sum(field.edge[t, labels[i], labels[j]] for i, j, t in edges)
        weight = np.exp(score)
        total += weight
        want[range(5), labels] += weight
        for k, (i, j, _) in enumerate(edges):
            pairs[k, labels[i], labels[j]] += weight
    assert np.allclose(node, want / total, atol=1e-3) and np.allclose(edge, pairs / total, atol=1e-3)


def test_distant_mentions_agree(field):
    """A number that a pattern finds once is labelled where it stands in another format; one that stands alone is not."""
    rng = random.Random(2)
    words = lambda: " ".join(rng.choice(("lorem", "ipsum", "dolor", "sit", "amet")) for _ in range(300))
    linked = alone = 0
    for _ in range(100):
        d = "".join(rng.choice("23456789") for _ in range(10))
        other = "".join(rng.choice("23456789") for _ in range(10))
        text = f"{words()} +1 ({d[:3]}) {d[3:6]}-{d[6:]} {words()} {d[:3]}.{d[3:6]}.{d[6:]} {words()} {other} {words()}"
        spans = found(field, text).split(",")
        linked += any(s.startswith("like_phone:" + str(text.index(f"{d[:3]}.{d[3:6]}.{d[6:]}"))) for s in spans)
        alone += any(s.startswith("like_phone:" + str(text.index(other))) for s in spans)
    assert linked >= 95 and alone <= 5


def test_names_of_addresses_agree(field):
    text = "write to ann.12@mail.example.com\n" + "much text " * 200 + "ask ann.12 about it and bob.34 too"
    at = text.index("ann.12 about")
    assert found(field, text) == f"email:9:32,like_email:{at}:{at + 6}"


def test_held_out_sentences(field):
    """Accuracy on composed documents that training has not seen."""
    made = entities.composed(seed=99, rounds=4)
    graph = entities.Graph.of(made)
    node, _ = field.marginals(graph, graph.observed)
    free = ~graph.observed
    right = node.argmax(1)[free] == graph.label[free]
    sure = (node.max(1) >= entities.SURE)[free] & (node.argmax(1)[free] > 0)
    assert right.mean() > 0.9 and right[sure].mean() > 0.97


def test_many_equal_mentions(field):
    text = "call +1 (212) 555-0182 " + "or 212-555-0182 " * 20000
    assert found(field, text).count("like_phone") == 20000


def test_odd_rows(spark, odd, field):
    rows = entities.scan(odd, field).collect()
    assert len(rows) == odd.count() and {r["spans"] for r in rows} == {""}
    assert entities.scan(odd.limit(0)).count() == 0
