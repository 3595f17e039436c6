import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from brute import LOWER, WORD
from salesmart.llm import lm, quality
from salesmart.llm.common import Words
from salesmart.llm.queries import QUERIES


def base(docs):
    """The base scores, word by word."""
    words = [(d, WORD.findall((t or "").translate(LOWER))) for d, t in docs]
    held = lambda d: d is None or zlib.crc32(str(d).encode()) % 7 == 2
    c = Counter(w for d, ws in words if not held(d) for w in [*ws, None])
    total, distinct = sum(c.values()), len(c)
    out = []
    for d, ws in words:
        logs = sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in [*ws, None])
        out.append((d, held(d), len(ws) + 1, sum(c[w] > 0 for w in [*ws, None]), total, logs))
    return out


def agree(rows, docs):
    order = lambda r: (r[0] is not None, r[0] or 0, r[2])
    got, want = sorted(map(tuple, rows), key=order), sorted(base(docs), key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    assert all(math.isfinite(r[6]) and r[6] <= 0 for r in got)


def test_query_against_plain_counts(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    agree(QUERIES["op5_recurrent_lm"](spark, sf).collect(), docs)


def test_rare_words_meet_their_counts_in_the_join(spark, sf, monkeypatch):
    monkeypatch.setattr(lm, "TOP", 2048)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    few = lm.score(docs, quality.held_out(7, 2)).collect()
    agree(few, [tuple(r) for r in docs.collect()])
    held = [r for r in few if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_held_out_likelihood_beats_the_base(spark):
    rows = QUERIES["op5_recurrent_lm"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_odd_rows(spark, odd):
    rows = lm.score(odd, quality.held_out(7, 2)).collect()
    agree(rows, [(r["doc_id"], r["text"]) for r in odd.collect()])
    same = [r for r in rows if r["doc_id"] == 6]
    assert len(same) == 2 and same[0][:6] == same[1][:6] and math.isclose(same[0]["score"], same[1]["score"], rel_tol=1e-6)
    assert lm.score(odd.limit(0), quality.held_out(7, 2)).count() == 0
    nothing = lm.score(odd.where("doc_id IS NULL"), quality.held_out(7, 2)).collect()
    assert [(r["n_known"], r["train_tokens"]) for r in nothing] == [(0, 0)]


def some_vocabulary(n=5000):
    count = np.sort(np.random.default_rng(0).integers(1, 1000, n))[::-1].astype(np.int64)
    return lm.Vocabulary.of(np.arange(1, n + 1).astype(np.uint64) * np.uint64(77), count, int(count.sum()) + 500, n + 300)


@pytest.mark.parametrize("n", [0, 5, 1024, 1500, 5000])
def test_probabilities_of_all_words_add_up_to_one(n):
    v = some_vocabulary(n)
    net = lm.Network.start(v)
    h = np.random.default_rng(1).normal(size=(1, lm.STATE)).astype(np.float32)
    rank = np.arange(n)
    kind, member = lm.Vocabulary.output(rank), np.where(rank < lm.HEAD, rank, 0) % lm.MEMBERS
    log, _ = net.outputs(np.repeat(h, n, axis=0), kind, member)
    p = np.exp(log + np.where(rank < lm.HEAD, 0, v.log_within)).sum()
    rare, _ = net.outputs(h, np.array([lm.OUTPUTS - 1]), np.array([0]))
    assert np.isclose(p + np.exp(rare[0]), 1, atol=1e-4)


def test_slopes_against_differences():
    rng = np.random.default_rng(2)
    net = lm.Network.empty(np.float64)
    net.flat[:] = rng.normal(0, 0.3, len(net.flat))
    code, fresh = rng.integers(0, lm.CODES + 1, (3, 5)), rng.random((3, 5)) < 0.2
    kind, member = rng.integers(0, lm.OUTPUTS, (3, 5)), rng.integers(0, lm.MEMBERS, (3, 5))
    h = rng.normal(size=(3, lm.STATE))
    loss = lambda: net.window(code, fresh, kind, member, h)[0]
    grad = net.window(code, fresh, kind, member, h)[2].flat
    some = np.concatenate((rng.choice(np.flatnonzero(grad), 60, replace=False), rng.choice(len(grad), 10)))
    for k in some:
        held = net.flat[k]
        net.flat[k] = held + 1e-5
        up = loss()
        net.flat[k] = held - 1e-5
        down = loss()
        net.flat[k] = held
        assert np.isclose((up - down) / 2e-5, grad[k], rtol=1e-4, atol=1e-7)


def test_state_is_carried_to_the_end_of_each_row():
    """Rows scored together and alone agree, and agree with the plain recurrence."""
    v = some_vocabulary()
    net = lm.Network.start(v)
    texts = [" ".join(f"w{k % 9}" for k in range(n)) for n in (70, 3, 0, 200, 1)]
    v.words[:9] = np.sort(Words(pa.array(["w0 w1 w2 w3 w4 w5 w6 w7 w8"])).hash)
    v = lm.Vocabulary.of(np.append(v.words[:9], lm.END), np.arange(100, 90, -1), 1200, 50)
    together, _ = lm.score_slice(Words(pa.array(texts)), v, net)
    for k, text in enumerate(texts):
        words = Words(pa.array([text]))
        assert np.isclose(lm.score_slice(words, v, net)[0][0], together[k], rtol=1e-5)
        rank, first = lm._stream(words, v)
        code, _ = lm._seen(rank, first)
        h, log = np.zeros((1, lm.STATE), np.float32), 0.0
        for c, r in zip(code, rank):
            h = net.step(np.array([c]), h)[0]
            log += net.outputs(h, lm.Vocabulary.output(np.array([r])), np.array([max(r, 0) % lm.MEMBERS]))[0][0]
        assert np.isclose(log, together[k], rtol=1e-4)


def test_every_token_is_learned_from_once_with_its_state(spark, monkeypatch):
    """All tokens of all documents, each behind its predecessor in one lane; long, short and empty ones."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 50, n)) for n in (0, 1, 31, 32, 63, 64, 65, 700, *rng.integers(0, 200, 300))]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    v = lm.vocabulary(lm.counts(docs))
    rounds = []
    for turn in range(lm.ROUNDS):
        rounds.append([r["text"] for r in docs.where(f"pmod(xxhash64(text), {lm.ROUNDS}) = {turn}").collect()])
    assert sorted(t for some in rounds for t in some) == sorted(texts) and all(rounds)
    net, taken, run = lm.Network.start(v), Counter(), lm.Network.window

    def window(self, code, fresh, kind, member, h, real=None):
        real = np.ones(code.shape, bool) if real is None else real
        taken.update(zip(code[real].tolist(), fresh[real].tolist(), kind[real].tolist(), member[real].tolist()))
        # a lane that goes on in a document brings a state along
        assert (fresh[:, 0] | (h != 0).any(axis=1)).all()
        return run(self, code, fresh, kind, member, h, real)

    monkeypatch.setattr(lm.Network, "window", window)
    lanes = lm.Lanes(net)
    want, seen = Counter(), 0
    for at in range(0, len(texts), 100):
        words = Words(pa.array(texts[at : at + 100]), lower=True)
        lanes.read(words, v)
        rank, first = lm._stream(words, v)
        code, fresh = lm._seen(rank, first)
        want.update(zip(code.tolist(), fresh.tolist(), lm.Vocabulary.output(rank).tolist(), (np.where(rank < lm.HEAD, rank, 0) % lm.MEMBERS).tolist()))
        seen += len(rank)
    lanes.finish()
    assert taken == want and lanes.seen == seen == sum(len(t.split()) + 1 for t in texts)


def test_padding_does_not_teach():
    rng = np.random.default_rng(3)
    net = lm.Network.empty(np.float64)
    net.flat[:] = rng.normal(0, 0.3, len(net.flat))
    code, fresh = rng.integers(0, lm.CODES + 1, (2, 6)), np.zeros((2, 6), bool)
    kind, member = rng.integers(0, lm.OUTPUTS, (2, 6)), rng.integers(0, lm.MEMBERS, (2, 6))
    h = rng.normal(size=(2, lm.STATE))
    real = np.arange(6) < np.array([6, 2])[:, None]
    loss, _, grad = net.window(code, fresh, kind, member, h, real)
    parts = [net.window(*(x[k : k + 1, :n] for x in (code, fresh, kind, member)), h[k : k + 1]) for k, n in ((0, 6), (1, 2))]
    assert np.isclose(loss, sum(p[0] for p in parts)) and np.allclose(grad.flat, sum(p[2].flat for p in parts))


def test_words_are_looked_for_in_their_slot_and_those_that_share_one_among_all(monkeypatch):
    base = np.uint64(7) << lm.SLOT_SHIFT
    words = np.array([base + np.uint64(k) for k in (5, 1, 9)] + [np.uint64(k) << lm.SLOT_SHIFT for k in range(8, 108)], np.uint64)
    v = lm.Vocabulary.of(words, np.arange(len(words), 0, -1).astype(np.int64), 6000, len(words) + 2)
    asked, plain = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, x, *more, **named: asked.append(np.size(x)) or plain(a, x, *more, **named))
    tokens = np.concatenate((words, words, [base + np.uint64(2), np.uint64(2**64 - 1)])).astype(np.uint64)
    assert v.ranks(tokens).tolist() == [*range(len(words)), *range(len(words)), -1, -1]
    assert sum(asked) == 6  # two words in a taken slot, twice, and two rare ones


def test_outputs_are_plain_softmaxes_and_their_slopes():
    rng, n = np.random.default_rng(3), 40
    net = lm.Network(rng.normal(0, 0.3, lm.Network.empty().flat.size))
    h, kind, member = rng.normal(size=(n, lm.STATE)), rng.integers(0, lm.OUTPUTS, n), rng.integers(0, lm.MEMBERS, n)
    grad = lm.Network.empty(np.float64)
    out, slope = net.outputs(h, kind, member, grad)

    def log(h, k, m):
        soft = lambda x: x - np.log(np.exp(x).sum())
        return soft(h @ net.o + net.ob)[k] + (soft(h @ net.m[k] + net.mb[k])[m] if k < lm.CLASSES else 0)

    assert np.allclose(out, [log(*row) for row in zip(h, kind, member)])
    step = 1e-6 * np.eye(lm.STATE)
    assert np.allclose(slope[:5], [[-(log(h[i] + s, kind[i], member[i]) - log(h[i] - s, kind[i], member[i])) / 2e-6 for s in step] for i in range(5)], atol=1e-5)
    for name, at in (("o", (3, 2)), ("ob", (1,)), ("m", (kind[kind < lm.CLASSES][0], 4, 6)), ("mb", (kind[kind < lm.CLASSES][0], 6))):
        w, had = getattr(net, name), getattr(net, name)[at]
        sums = []
        for d in (1e-6, -1e-6):
            w[at] = had + d
            sums.append(-sum(log(*row) for row in zip(h, kind, member)))
        w[at] = had
        assert np.isclose(getattr(grad, name)[at], (sums[0] - sums[1]) / 2e-6, atol=1e-5)


def test_steps_beyond_one_window_are_windows_in_succession():
    rng, n = np.random.default_rng(5), 3 * lm.BACK
    net = lm.Network.empty(np.float64)
    net.flat[:] = rng.normal(0, 0.3, len(net.flat))
    code, fresh = rng.integers(0, lm.CODES + 1, (2, n)), rng.random((2, n)) < 0.03
    kind, member = rng.integers(0, lm.OUTPUTS, (2, n)), rng.integers(0, lm.MEMBERS, (2, n))
    h, real = rng.normal(size=(2, lm.STATE)), np.arange(n) < np.array([n, n - 40])[:, None]
    loss, last, grad = net.window(code, fresh, kind, member, h, real)
    state, losses, slopes = h, 0.0, np.zeros_like(net.flat)
    for a in range(0, n, lm.BACK):
        part = slice(a, a + lm.BACK)
        one, state, own = net.window(*(x[:, part] for x in (code, fresh, kind, member)), state, real[:, part])
        losses, slopes = losses + one, slopes + own.flat
    assert np.isclose(loss, losses) and np.allclose(last, state) and np.allclose(grad.flat, slopes)


def test_long_documents_at_the_end_take_few_windows_and_the_same_updates(monkeypatch):
    v = some_vocabulary()
    rng = np.random.default_rng(6)
    held = [np.stack([rng.integers(0, lm.CODES, n), np.arange(n) == 0, rng.integers(0, lm.OUTPUTS, n), rng.integers(0, lm.MEMBERS, n)], axis=1).astype(np.int16) for n in (9000, 5000, 700, 31, *[40] * 90)]
    calls, run = [], lm.Network.window
    monkeypatch.setattr(lm.Network, "window", lambda self, code, *more: calls.append(code.size) or run(self, code, *more))

    def lanes():
        one = lm.Lanes(lm.Network.start(v))
        one.held[: len(held)], one.left[: len(held)] = held, [len(x) for x in held]
        return one

    together, singly = lanes(), lanes()
    together.finish()
    few = len(calls)
    while len(some := np.flatnonzero(singly.left)):
        singly.window(some)
    singly.update()
    assert together.seen == singly.seen == sum(map(len, held)) and together.adam.t == singly.adam.t
    assert few < 20 < len(calls) - few and max(calls) < 4 * lm.LEAST_UPDATE
    assert np.allclose(together.net.flat, singly.net.flat, atol=1e-3)


@pytest.mark.parametrize("kind", [np.float32, np.float64])
def test_rows_are_added_by_their_code(kind):
    rng = np.random.default_rng(7)
    code, rows = rng.integers(0, 40, 300), rng.normal(size=(300, 6)).astype(kind)
    got, want = np.ones((50, 6), kind), np.ones((50, 6), kind)
    lm.add_rows(got, code, rows)
    np.add.at(want, code, rows)
    assert np.allclose(got, want, atol=1e-4)
