import zlib

import numpy as np
from tokenizers import Tokenizer

from salesmart.llm import tokenfiles
from salesmart.llm.queries import QUERIES, tokenizer


def expected(docs):
    t = Tokenizer.from_file(tokenizer())
    out, start = [], 0
    for doc, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, d[1] or "")):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def by_start(rows):
    return sorted((tuple(r)[:4] for r in rows), key=lambda r: r[1])


def test_query_against_plain_tokenizer(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert by_start(QUERIES["op4_token_shards"](spark, sf).collect()) == expected(docs)


def test_odd_rows_and_tokens(spark, odd):
    rows = tokenfiles.round_trip(odd, tokenizer(), tokens=True).collect()
    assert by_start(rows) == expected([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["n_tokens"] for r in rows)


def test_empty_table(spark, odd):
    assert tokenfiles.round_trip(odd.limit(0), tokenizer()).count() == 0


def test_wide_ids_and_text_keys(spark):
    docs = spark.createDataFrame([(k, "text " + k) for k in ("b", "a", "ccc")], "doc_id string, text string")
    rows = tokenfiles.round_trip(docs, tokenizer(), width=4).collect()
    assert by_start(rows) == expected([("a", "text a"), ("b", "text b"), ("ccc", "text ccc")])


def test_perfect_hash_is_minimal_and_rejects_strangers():
    hashes = tokenfiles.key_hashes(list(range(20_000)))
    index = tokenfiles.Index(tokenfiles.dump_index(hashes, np.arange(20_000), np.ones(20_000), np.arange(20_001), 2))
    assert sorted(index.function.slots(hashes).tolist()) == list(range(20_000))
    first, count = index.find(hashes)
    assert (first == np.arange(20_000)).all() and (count == 1).all()
    _, strangers = index.find(tokenfiles.key_hashes(list(range(10**6, 10**6 + 20_000))))
    assert strangers.sum() <= 2
