import numpy as np
import pyarrow as pa
import pytest

from brute import LOWER, WORD
from salesmart.llm.common import Words, gram_hashes, inside, mix, slices, word_hashes

TEXTS = ["", None, " a  b\tc\n", "A é|ß x\x0b\x0c\r\n\x1c y", "x" * 200 + " " + "x" * 201, "one", "two three", "\n\n", "tail ", "日本 語", "x" * 64, "x" * 65]


@pytest.mark.parametrize("lower", [False, True])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_of_a_slice(lower, kind):
    words = Words(pa.array(["skipped words", *TEXTS], kind).slice(1), lower)
    want = [WORD.findall((t or "").translate(LOWER) if lower else t or "") for t in TEXTS]
    raw = words.data.tobytes()
    got = [raw[a:b].decode() for a, b in zip(words.start, words.end)]
    assert [got[a:b] for a, b in zip(words.first, words.first[1:])] == want
    assert words.doc.tolist() == [k for k, w in enumerate(want) for _ in w]


def test_hashes_do_not_depend_on_the_slice():
    whole = Words(pa.array(TEXTS)).hash
    alone = np.concatenate([Words(pa.array([t], pa.string())).hash for t in TEXTS])
    assert (whole == alone).all()
    names = [w for t in TEXTS for w in WORD.findall(t or "")]
    assert len(set(whole.tolist())) == len(set(names))


def test_grams_lie_inside_rows():
    words = Words(pa.array(["a b c", "b c", "a b c d"]))
    h = gram_hashes(words.hash, 2)
    assert inside(words, 2).tolist() == [True, True, False, True, False, True, True, True]
    assert h[0] == h[5] and h[1] == h[3] == h[6] and h[0] != h[1]


def test_slices_hold_every_row_once():
    batch = pa.record_batch([pa.array([None, "x" * 50, "", "y" * 500, *["z" * 30] * 20])], ["text"])
    parts = list(slices([batch, batch.slice(0, 0)], "text", 100))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    assert max(p.num_rows for p in parts) < 8


def test_hashes_are_the_polynomial_in_any_order():
    rng, M, all_bits = np.random.default_rng(0), 0x9E3779B97F4A7C15, (1 << 64) - 1
    data = rng.integers(0, 256, 150_000).astype(np.uint8)
    start = np.sort(rng.integers(0, 100_000, 400))
    length = rng.integers(1, 70, 400)
    length[::50] = 300
    length[7] = 40_000

    def plain(a, n):
        total = 0
        for k, byte in enumerate(data[a : a + n].tolist()):
            total += (byte + 1) * pow(M, k & 63, 1 << 64) * ((k >> 6) * 0xD1342543DE82EF94 + 1)
        return (total & all_bits) ^ (int(n) << 48)

    want = mix(np.array([plain(a, n) for a, n in zip(start, length)], np.uint64))
    assert (word_hashes(data, start, start + length) == want).all()
    order = rng.permutation(400)
    assert (word_hashes(data, start[order], (start + length)[order]) == want[order]).all()
    assert (word_hashes(data, np.array([149_999]), np.array([150_000])) == mix(np.array([plain(149_999, 1)], np.uint64))).all()
