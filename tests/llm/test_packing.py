import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from salesmart.llm import packing, tokens
from salesmart.llm.queries import QUERIES, tokenizer
from salesmart.llm.tokens import Encoder


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(tokenizer())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def check(rows, texts, plain, capacity):
    """Every id of every document lies in one piece; sequences are gapless and within the capacity."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == {d for d, _ in texts}
    for doc, text in texts:
        ids = np.array([*plain(text), 1], "<u4")
        copies = sum(d == doc for d, _ in texts)
        at = 0
        for start, some in sorted({r["start"]: r for r in by_doc[doc]}.items()):
            assert start == at and some["doc_tokens"] == len(ids)
            assert some["ids_crc32"] == zlib.crc32(ids[at : at + some["length"]].tobytes())
            at += some["length"]
        assert at == len(ids)
        assert sum(r["length"] for r in by_doc[doc]) == copies * len(ids)
    padding = 0
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / (capacity * len(by_seq))


def test_query_against_plain_tokenizer(spark, sf, plain):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op1_harmonic_packing"](spark, sf).collect()
    assert check(rows, [tuple(d) for d in docs], plain, 2048) < 0.02


def test_odd_rows(spark, odd, plain):
    rows = packing.pack(odd, tokenizer()).collect()
    assert all(zlib.crc32(np.frombuffer(r["ids"], "<u2").astype("<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == 2 * r["length"] for r in rows)
    check(rows, [(r["doc_id"], r["text"]) for r in odd.collect()], plain, 2048)


def test_empty_table(spark, odd):
    assert packing.pack(odd.limit(0), tokenizer()).count() == 0


@pytest.mark.parametrize("capacity", [1, 2, 7, 100, 2048])
def test_cuts_are_class_lengths(capacity):
    sizes = set(packing.class_sizes(capacity))
    for rest, cut in enumerate(packing.cut_table(capacity)):
        assert sum(cut) == rest and set(cut) <= sizes


def test_leftovers_fit():
    totals = {s: 3 * s + 1 for s in packing.class_sizes(100)}
    places, used = packing.leftovers(totals, 100)
    fill = [0] * used
    for size, _, seq, offset in places:
        assert offset == fill[seq]
        fill[seq] += size
    assert max(fill) <= 100
    assert len({(s, k) for s, k, _, _ in places}) == len(places) == sum(n % (100 // s) for s, n in totals.items())


def test_encoder_matches_whole_texts(plain):
    texts = ["", " ", "a  b", "a\n\n b", "tab\t\tx ", "it's \x1c\x1d x\x85y\xa0 z", "日本　語  12 345", "<|endoftext|> <|endoftext|>", "  lead", "trail  \n ", "a  b ​ c", "\x00 nul", "x" * 500 + " " * 300 + "y"]
    assert [np.frombuffer(b, "<u4").tolist() for b in Encoder(tokenizer())(texts)] == [plain(t) for t in texts]


@pytest.mark.parametrize("cached", [0, 50, 10**6])
def test_encoder_matches_random_texts(plain, cached):
    """Whatever is known already, and with every kind of white space, punctuation and special token."""
    rng, encode = random.Random(cached), Encoder(tokenizer(), cached)
    parts = [*"aZ\u00e9\u65e5.,;:!?'|<>()\x1c\x85\xa0\u2003\u3000 \t\n\r0", "<|endoftext|>", " the", "'s", "it's", "  ", "\u2003 ", ".. ", "a,b", "word.\n", "\U0001f600", "\u201d "]
    for _ in range(20):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(60)] + [None]
        assert [np.frombuffer(b, "<u4").tolist() for b in encode(texts)] == [plain(t) for t in texts]


def test_chunks_of_one_hash(plain, monkeypatch):
    """Chunks are told apart by their bytes: here nearly all hashes are equal."""
    monkeypatch.setattr(tokens, "word_hashes", lambda data, start, end: (end - start).astype(np.uint64) % np.uint64(2))
    encode = Encoder(tokenizer())
    for texts in (["a bc def, gh a bc", "zz a"], ["bc a def xyz", "q", ""], ["gh gh bc"]):
        assert [np.frombuffer(b, "<u4").tolist() for b in encode(texts)] == [plain(t) for t in texts]
