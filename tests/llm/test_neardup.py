import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brute import near_components
from salesmart.llm import neardup
from salesmart.llm.queries import QUERIES


def agree(rows, docs):
    want = near_components(docs)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert got == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def copies(rng, base, n, least, most):
    """Copies of ``base`` with some words replaced."""
    out = []
    for _ in range(n):
        w = list(base)
        for k in rng.choice(len(w), rng.integers(least, most), replace=False):
            w[k] = f"n{rng.integers(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def groups():
    """Random texts, and groups of copies of all degrees around the threshold."""
    rng = np.random.default_rng(11)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 4000, rng.integers(1, 200))) for _ in range(150)]
    for size, least, most in ((40, 0, 4), (60, 2, 9), (30, 5, 14)):
        texts += copies(rng, [f"b{k}" for k in rng.integers(0, 4000, 120)], size, least, most)
    passage = " ".join(f"p{k}" for k in range(40))
    texts += [passage + " " + " ".join(f"w{k}" for k in rng.integers(0, 4000, 60)) for _ in range(60)]
    texts += ["", None, " ", "one", "ONE", "one two", "Two one", "one two three", "a b c d", "A B C D", "a b c d"]
    order = rng.permutation(len(texts))
    return [(int(k), texts[i]) for k, i in enumerate(order)]


def test_query_against_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    agree(QUERIES["op10_chosen_path"](spark, sf).collect(), docs)


def test_groups_around_the_threshold(spark, groups):
    agree(neardup.near_duplicates(spark.createDataFrame(groups, "doc_id long, text string")).collect(), groups)


def test_branching_and_blocks_give_the_same(spark, groups, monkeypatch):
    monkeypatch.setattr(neardup, "NODE", 8)
    monkeypatch.setattr(neardup, "CLUSTER_BYTES", 20_000)
    agree(neardup.near_duplicates(spark.createDataFrame(groups, "doc_id long, text string")).collect(), groups)


def test_odd_rows(spark, odd):
    rows = neardup.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert found[2] == (0, 2, True) and found[3] == (0, 3, True) and found[4] == (0, 4, True)
    assert found[5] == (1, 5, True) and found[6][1:] == (1, False) and found[9][0] == 1
    assert found[None][:2] == (1, None)
    left = neardup.deduplicate(odd)
    assert left.columns == odd.columns and 6 not in {r["doc_id"] for r in left.collect()}
    assert neardup.near_duplicates(odd.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    rng = np.random.default_rng(2)
    names = rng.permutation(300).tolist()
    edges = [(names[k], names[k + 1]) for k in range(150)] + [(names[200], names[k]) for k in range(201, 260)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in neardup.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    first, second = names[:151], names[200:260]
    assert got == {n: min(part) for part in (first, second) for n in part}


def test_rounds_for_a_path_in_order(spark, monkeypatch):
    rounds, real = [], neardup.settle
    monkeypatch.setattr(neardup, "settle", lambda df, name, **more: (rounds.append(name), real(df, name, **more))[1])
    edges = spark.range(9_999).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    got = neardup.components(edges)
    assert got.count() == 10_000 and got.where("component <> 0").isEmpty()
    assert rounds.count("neardup-moves") < 40


def test_large_groups_of_near_copies_in_linear_work(spark, monkeypatch):
    """A third of all texts are near copies of one: what the blocks hold grows with the group, not with its square."""
    rng = np.random.default_rng(12)
    texts = copies(rng, [f"b{k}" for k in range(100)], 400, 0, 3) + [" ".join(f"w{k}" for k in rng.integers(0, 10**6, 80)) for _ in range(800)]
    docs = [(k, texts[i]) for k, i in enumerate(rng.permutation(len(texts)).tolist())]
    compared, real = [], neardup._forest_edges
    monkeypatch.setattr(neardup, "NODE", 40)
    monkeypatch.setattr(neardup, "CLUSTER_BYTES", 40_000)
    monkeypatch.setattr(neardup, "_forest_edges", lambda rows, key, *rest: (compared.append(rows.count()) if key == "key" else None, real(rows, key, *rest))[1])
    agree(neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)
    # sketches of up to 16 trees and all branches, then the sets
    assert compared and compared[-1] <= 3 * 400


def test_links_across_the_blocks_of_a_chain(spark):
    """Neighbours of a chain are linked, others are not: pivots join little, the rest is compared as a whole."""
    words = [f"c{k}" for k in range(400)]
    sets_ = [(k, np.sort(np.array([hash(w) & 0xFFFFFFFF for w in words[k * 5 : k * 5 + 60]], np.uint64)).tobytes()) for k in range(60)]
    rows = spark.createDataFrame([(1, rep, bytearray(t)) for rep, t in sets_] + [(2, 100 + rep, bytearray(t)) for rep, t in sets_[::3]], "cluster long, rep long, tokens binary")
    by_set = lambda values: neardup.exact_forest([np.frombuffer(v, np.uint64) for v in values])
    edges = neardup.large_edges(rows, "cluster", "tokens", F.length("tokens"), 4 * 480, by_set)
    got = {r["node"]: r["component"] for r in neardup.components(edges).collect()}
    assert got == {k: 0 for k in range(60)}


def test_exact_forest_at_the_threshold():
    base = np.arange(90, dtype=np.uint64)
    # 80 of 100 in common, then 79 of 101
    assert neardup.exact_forest([base, np.concatenate((base[:80], base[:10] + np.uint64(1000)))]).root.tolist() == [0, 0]
    assert neardup.exact_forest([base, np.concatenate((base[:79], base[:11] + np.uint64(2000)))]).root.tolist() == [0, 1]
    assert neardup.exact_forest([base[:4], base[:5]]).root.tolist() == [0, 0]
    assert neardup.exact_forest([base[:3], base[:4]]).root.tolist() == [0, 1]


def test_shingle_sets_of_short_texts():
    sets = neardup.shingle_sets(pa.array(["a", "A", "a b", "b a", "", None, "a b c d", "a b c d e"]))
    assert sets[0].tolist() == sets[1].tolist() != sets[2].tolist() != sets[3].tolist()
    assert [len(s) for s in sets] == [1, 1, 1, 1, 0, 0, 1, 2]


def test_null_and_repeated_ids_lose_copies_only(spark):
    """Rows without an id, or of one id, go only where another row has nearly their text."""
    rng = np.random.default_rng(9)
    clean = [" ".join(f"c{k}" for k in rng.integers(0, 10**6, 60)) for _ in range(90)]
    ids = [k if k % 3 == 0 else None if k % 3 == 1 else 1000 for k in range(90)]
    rows = list(zip(ids, clean))
    base = [f"b{k}" for k in range(100)]
    near = copies(rng, base, 3, 1, 3)
    # exact and near copies without an id, of one id, and of other ids
    groups = [[(None, near[0]), (None, near[1]), (None, near[0])], [(500, f"d {near[0]}".replace("b", "x")), (500, f"d {near[1]}".replace("b", "x"))], [(700, near[2].replace("b", "y")), (None, near[1].replace("b", "y"))]]
    blank = [(None, ""), (None, " "), (None, None), (2000, ""), (2000, "\t"), (2001, "")]
    docs = spark.createDataFrame(rows + [r for g in groups for r in g] + blank + [(2000, "")], "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in neardup.deduplicate(docs).collect()]
    assert set(rows) <= set(got) and set(blank) <= set(got)
    assert [sum(r in g for r in got) for g in groups] == [1, 1, 1] and groups[2][0] in got
    assert len(got) == len(set(got)) == len(rows) + len(blank) + 3
    links = {(r["doc_id"], r["component_id"]) for r in neardup.near_duplicates(docs).collect()}
    assert (None, 700) in links
