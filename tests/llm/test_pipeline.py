import re

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from brute import near_components
from salesmart.llm import quality
from salesmart.llm.queries import tokenizer
from test_decontam import brute as contaminated
from test_packing import check
from test_secrets import plain as spans


@pytest.fixture(scope="module")
def stages(spark, sf):
    """The rows after each stage, the first being the table itself."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf).cache()
        docs.count()
        out.append(docs)
    return out


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "MinHash near-dedup", "benchmark decontamination", "secret scans", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
    for df in stages[1:-1]:
        assert df.schema == stages[0].schema


def test_quality(spark, sf, stages):
    before, after = by_id(stages[0]), by_id(stages[1])
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scores = {r["doc_id"]: r["score"] for r in quality.score(stages[0], labels).collect()}
    assert after == {d: r for d, r in before.items() if scores[d] >= 0.3}
    good = [r["doc_id"] for r in labels.where("quality = 1").collect()]
    assert sum(d in after for d in good) >= 0.98 * len(good)


def test_near_duplicates(stages):
    before, after = by_id(stages[1]), by_id(stages[2])
    want = near_components([(d, r["text"]) for d, r in before.items()], size=5)
    assert after == {d: r for d, r in before.items() if want[d][1] == d}


def test_decontamination(spark, sf, stages):
    before, after = by_id(stages[2]), by_id(stages[3])
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    bad = contaminated([(d, r["text"]) for d, r in before.items()], items)
    assert after == {d: r for d, r in before.items() if d not in bad}


def test_secrets(stages):
    before, after = by_id(stages[3]), by_id(stages[4])
    assert set(before) == set(after)
    for d, r in before.items():
        found = [tuple(map(int, s.split(":")[1:])) for s in spans(r["text"]).split(",") if s]
        text, at = "", 0
        for a, b in found:
            if a >= at:
                text += r["text"][at:a] + "[SECRET]"
            at = max(at, b)
        text += r["text"][at:]
        assert after[d]["text"] == text and after[d]["n_chars"] == (len(text) if found else r["n_chars"])
        assert not re.search("[0-9a-f]{32}", after[d]["text"])


def test_packing(stages):
    t = Tokenizer.from_file(tokenizer())
    docs = [(d, r["text"]) for d, r in by_id(stages[4]).items()]
    rows = stages[5].collect()
    check(rows, docs, lambda text: t.encode(text or "", add_special_tokens=False).ids, 2048)
    assert all(len(np.frombuffer(r["ids"], "<u2")) == r["length"] for r in rows)


def test_run_gives_the_last_stage(spark, sf, stages):
    key = lambda df: sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert key(corpus_pipeline.run(spark, sf)) == key(stages[5])


def test_odd_rows(spark, sf, odd):
    """Through all stages without a crash; an empty table gives no row."""
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == odd.columns
    assert corpus_pipeline.packed(spark, docs, sf).count() >= docs.count()
    ids = [r["doc_id"] for r in corpus_pipeline.one_of_each(spark, odd, sf).collect()]
    assert len(ids) == len(set(ids)) and 1 in ids and 6 not in ids and None in ids
    none = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, sf)
        assert none.count() == 0
