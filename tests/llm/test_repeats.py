import hashlib

import numpy as np
import pyarrow as pa
import pytest

from brute import repeats as brute
from salesmart.llm import repeats
from salesmart.llm.common import Words
from salesmart.llm.queries import QUERIES


def agree(rows, docs):
    want = brute(docs)
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in rows} == want
    assert len(rows) == len(docs)


@pytest.fixture(scope="module")
def groups():
    """A shared passage at different places, copies, texts that repeat themselves, and texts around the window's length."""
    rng = np.random.default_rng(4)
    words = lambda n: [f"w{k}" for k in rng.integers(0, 500, n)]
    passage, long = words(60), words(300)
    texts = [words(rng.integers(0, 40)) + passage + words(rng.integers(0, 40)) for _ in range(60)]
    texts += [long, list(long), long[:150] + ["new"] + long[150:], long[10:200], words(12), long[20:32], long[20:33], long[20:34]]
    texts += [["the"] * 400, ["the"] * 13, ["the"] * 12, ["a", "b", "c"] * 50, words(5) * 30, [], ["x" * 300] * 40]
    order = rng.permutation(len(texts)).tolist()
    blanks = [" ", "\n", "  \t", "\r\n"]
    return [(k, "".join(w + blanks[rng.integers(4)] for w in texts[i])) for k, i in enumerate(order)] + [(900, None), (901, " \n")]


def test_query_against_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = {d: (n, g, hashlib.sha256(k.encode()).hexdigest()) for d, (n, g, k) in brute(docs).items()}
    assert {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op2_super_kmers"](spark, sf).collect()} == want


def test_groups(spark, groups):
    agree(repeats.remove_repeats(spark.createDataFrame(groups, "doc_id long, text string").repartition(5)).collect(), groups)


@pytest.mark.parametrize("bucket, frequent", [(500, 2.0**-15), (1 << 30, 1.0), (3000, 2.0**-9)])
def test_buckets_and_frequent_runs_give_the_same(spark, groups, monkeypatch, bucket, frequent):
    monkeypatch.setattr(repeats, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(repeats, "FREQUENT", frequent)
    agree(repeats.remove_repeats(spark.createDataFrame(groups, "doc_id int, text string").repartition(3)).collect(), groups)


@pytest.mark.parametrize("whole, part", [(1, 1), (2000, 500), (30_000, 4000)])
def test_buckets_read_in_parts_give_the_same(spark, groups, monkeypatch, whole, part):
    """One bucket that is larger than a task may hold: its windows meet in the second shuffle."""
    monkeypatch.setattr(repeats, "WHOLE_BYTES", whole)
    monkeypatch.setattr(repeats, "PART_BYTES", part)
    monkeypatch.setattr(repeats, "PACK_BYTES", 2000)
    agree(repeats.remove_repeats(spark.createDataFrame(groups, "doc_id long, text string").repartition(4)).collect(), groups)


def test_a_third_of_the_rows_in_one_bucket(spark, monkeypatch):
    """A passage of a third of the documents, with its own edges in each, and more buckets than partitions."""
    rng = np.random.default_rng(11)
    passage = [f"p{k}" for k in range(80)]
    docs = []
    for k in range(600):
        own = [f"w{j}" for j in rng.integers(0, 3000, 50)]
        docs.append((k, " ".join(own[:20] + (passage if k % 3 == 0 else []) + own[20:])))
    monkeypatch.setattr(repeats, "WHOLE_BYTES", 3000)
    monkeypatch.setattr(repeats, "PART_BYTES", 1000)
    monkeypatch.setattr(repeats, "PACK_BYTES", 5000)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 5000)
    monkeypatch.setattr(repeats, "TASK_BUCKETS", 2)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    agree(repeats.remove_repeats(table).collect(), docs)
    assert repeats.repeated_spans(table).count() == 199


def test_odd_rows(spark, odd):
    rows = repeats.remove_repeats(odd).collect()
    assert len(rows) == odd.count()
    found = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in rows}
    assert found[2] == found[3] == found[4] == (0, 0) and found[1] == (360, 0) and found[6] == (360, 360)
    assert found[9] == (5000, 0) and found[7] == (1, 0) and found[None] == (3, 0)
    assert repeats.remove_repeats(odd.limit(0)).count() == 0


def test_minimisers_are_those_of_the_window_alone():
    rng = np.random.default_rng(6)
    w = [f"w{k}" for k in rng.integers(0, 50, 200)]
    frequent = rng.random(1 << repeats.CELL_BITS) < 0.3
    low = repeats.minimisers(Words(pa.array([" ".join(w)])), frequent)
    assert len(low) == 188
    for k in range(0, 188, 17):
        assert repeats.minimisers(Words(pa.array([" ".join(w[k : k + 13])])), frequent).tolist() == [low[k]]
