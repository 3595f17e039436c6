"""Log-likelihood of documents under a gated recurrent language model.

*Counts.*  The training documents' words are counted exactly (a word is its
64-bit hash).  The TOP commonest words, a table of fixed size, go to every
task; all others are *rare* and meet their counts in a join, as sums per
document.  Lower-cased A-Z; one end token a document, counted as a word.

*Classes.*  The output softmax is factored: the commonest HEAD words form
classes of MEMBERS neighbours in frequency, each with a softmax of its own;
the words behind them form classes by rank (doubling), and rare words one
class.  Inside those a word's probability is its share of the class's counts,
with one added to each word and one word that stands for all unseen ones - the
same events as the base score's, so that the two can be compared.

*Model.*  A gated recurrent unit in numpy, trained by backpropagation through
BACK steps.  Each training document belongs to one of ROUNDS rounds, by a hash
of its text, and is read there to its end, so that every token is learned from
once.  Every partition reads its documents in BATCH lanes, each document in one
lane with its state carried from window to window; after each round the
partitions' weights are averaged, summed chunk by chunk on the executors.  It
starts as the unigram model.

*Scores.*  A document is read whole, its state carried to its end.

NULL and empty texts are the end token alone.  NULL ids are never learned
from.  Repeated rows score alike.  Without training documents every word is
unseen.  An empty table gives no row.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from heapq import heapify, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import Words, mix, release, settle, slices, texts

#: Words known to every task; words with a softmax over their class; members of such a class.
TOP, HEAD, MEMBERS = 1 << 18, 1024, 32
#: State size, steps of backpropagation, lanes of documents that are read side by side.
STATE, BACK, BATCH = 24, 32, 256
#: Tokens of an update, at least; waiting tokens from which a window is taken however few lanes are filled.
LEAST_UPDATE, WAITING = BATCH * BACK // 2, 1 << 20
#: Rounds of averaging.
ROUNDS = 3
RATE, SEED = 0.01, 20252
#: Bits of a hash that name its slot; no word is looked for but in its slot, or else among all.
SLOT_BITS = 20
SLOT_SHIFT = np.uint64(64 - SLOT_BITS)
#: Bytes of text that are scored together; values of a chunk of weights.
SCORE_BYTES, CHUNK = 12 << 20, 4096
END = np.uint64(0x3C6EF372FE94F82B)
_COUNTED = 1_500_000

CLASSES = HEAD // MEMBERS
#: Classes by rank behind the head: HEAD to 2 * HEAD, and so on up to TOP; then the rare ones.
RANKED = (TOP // HEAD).bit_length() - 1
OUTPUTS = CLASSES + RANKED + 1
CODES = HEAD + RANKED + 1
START = CODES


@dataclass
class Vocabulary:
    """The TOP commonest words with their counts, and the sums over all words."""

    words: np.ndarray  # hashes, sorted
    rank: np.ndarray
    count: np.ndarray  # by rank
    total: int
    distinct: int
    log_within: np.ndarray = field(default=None)  # by rank, natural log of the share of the class
    rare_mass: int = 0
    slots: np.ndarray = field(default=None)  # place in ``words`` by a hash's first bits

    @classmethod
    def of(cls, hashes: np.ndarray, count: np.ndarray, total: int, distinct: int) -> Vocabulary:
        order = np.argsort(hashes, kind="stable")
        v = cls(hashes[order], order, count, total, distinct)
        kind = v.output(np.arange(len(count)))
        mass = np.bincount(kind, count + 1.0, OUTPUTS)
        v.rare_mass = (total - int(count.sum())) + (distinct - len(count)) + 1
        v.mass = np.append(mass[:-1], v.rare_mass)
        v.log_within = np.log((count + 1.0) / v.mass[kind]) if len(count) else np.zeros(0)
        return v

    def ranks(self, hashes: np.ndarray) -> np.ndarray:
        """Rank of each word; -1 for rare ones."""
        if not len(self.words):
            return np.full(len(hashes), -1)
        if self.slots is None:
            # the commonest word of each slot; made by the task, so that it does not travel
            self.slots = np.zeros(1 << SLOT_BITS, np.int32)
            places = np.empty(len(self.words), np.int32)
            places[self.rank] = np.arange(len(self.words), dtype=np.int32)
            places = places[::-1]
            self.slots[self.words[places] >> SLOT_SHIFT] = places
        at = self.slots[hashes >> SLOT_SHIFT].astype(np.int64)
        # words that share their slot with a commoner one, and rare ones
        other = np.flatnonzero(self.words[at] != hashes)
        place = np.searchsorted(self.words, hashes[other])
        place[place == len(self.words)] = 0
        at[other] = place
        return np.where(self.words[at] == hashes, self.rank[at], -1)

    @staticmethod
    def output(rank: np.ndarray) -> np.ndarray:
        """Output class of each rank."""
        behind = np.floor(np.log2(np.maximum(rank, 1) / HEAD)).astype(np.int64) + CLASSES
        return np.where(rank < 0, OUTPUTS - 1, np.where(rank < HEAD, rank // MEMBERS, behind))

    @staticmethod
    def code(rank: np.ndarray) -> np.ndarray:
        """What the model sees of each rank: the word in the head, else its class."""
        return np.where((rank >= 0) & (rank < HEAD), rank, Vocabulary.output(rank) - CLASSES + HEAD)


def _lengths() -> dict[str, tuple[int, ...]]:
    return {"x": (CODES + 1, 3 * STATE), "u": (STATE, 2 * STATE), "c": (STATE, STATE), "o": (STATE, OUTPUTS), "ob": (OUTPUTS,), "m": (CLASSES, STATE, MEMBERS), "mb": (CLASSES, MEMBERS)}


class Network:
    """The weights as views of one flat vector."""

    def __init__(self, flat: np.ndarray):
        self.flat, at = flat, 0
        for name, shape in _lengths().items():
            size = int(np.prod(shape))
            setattr(self, name, flat[at : at + size].reshape(shape))
            at += size

    @classmethod
    def empty(cls, kind=np.float32) -> Network:
        return cls(np.zeros(sum(int(np.prod(s)) for s in _lengths().values()), kind))

    @classmethod
    def start(cls, v: Vocabulary) -> Network:
        net, rng = cls.empty(), np.random.default_rng(SEED)
        net.x[:] = rng.normal(0, 0.3, net.x.shape)
        net.u[:], net.c[:] = (rng.normal(0, STATE**-0.5, w.shape) for w in (net.u, net.c))
        net.o[:] = rng.normal(0, 0.05, net.o.shape)
        with np.errstate(divide="ignore"):
            net.ob[:] = np.maximum(np.log(v.mass / v.mass.sum()), -30)
        members = np.full(HEAD, -30.0)
        known = min(HEAD, len(v.count))
        members[:known] = v.log_within[:known]
        net.mb[:] = members.reshape(CLASSES, MEMBERS)
        return net

    def gates(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The recurrent weights gate by gate, so that a step's arrays have no gaps; those of the two sigmoids negated."""
        x = np.ascontiguousarray(self.x.reshape(-1, 3, STATE).transpose(1, 0, 2))
        np.negative(x[:2], out=x[:2])
        return x, -np.ascontiguousarray(self.u.reshape(STATE, 2, STATE).transpose(1, 0, 2)), self.c

    @staticmethod
    def turn(g: np.ndarray, h: np.ndarray, u: np.ndarray, w: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
        """The next state; ``g`` holds the seen words' rows of each gate and then the gates."""
        a, c = g[:2], g[2]
        a += h @ u
        np.exp(a, out=a)
        a += 1
        np.reciprocal(a, out=a)
        z, r = a
        c += (r * h) @ w
        np.tanh(c, out=c)
        new = np.subtract(c, h, out=out)
        new *= z
        new += h
        return new

    def step(self, code: np.ndarray, h: np.ndarray, gates: tuple | None = None) -> tuple:
        """The next state and the gates; ``gates`` as from ``gates()`` where many steps are taken."""
        x, u, w = gates or self.gates()
        g = np.take(x, code, axis=1, mode="clip")
        return self.turn(g, h, u, w), *g

    def outputs(self, h: np.ndarray, kind: np.ndarray, member: np.ndarray, grad: Network | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probability of each class and head member; with ``grad``, the loss's slope by ``h`` and its weights."""
        # classes run along the first axis: what is summed over them are whole rows of memory
        wide, rows = np.ascontiguousarray(h.T), np.arange(len(h))
        p = self.o.T @ wide
        p += self.ob[:, None]
        p -= p.max(axis=0)
        own = p[kind, rows]
        np.exp(p, out=p)
        norm = p.sum(axis=0)
        out = (own - np.log(norm)).astype(np.float64)
        slope = None
        if grad is not None:
            p /= norm
            p[kind, rows] -= 1
            grad.o += wide @ p.T
            grad.ob += p.sum(axis=1)
            slope = p.T @ self.o.T
        # OUTPUTS is small: 16 bits are sorted by digits
        order = np.argsort(kind.astype(np.int16), kind="stable")
        edges = np.searchsorted(kind[order], np.arange(CLASSES + 1))
        order = order[: edges[CLASSES]]
        if not len(order):
            return out, slope
        # only the products are made class by class
        head, own = np.take(h, order, axis=0), (rows[: len(order)], member[order])
        p = np.empty((len(order), MEMBERS), np.result_type(h, self.m))
        some = [(k, slice(a, b)) for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())) if a < b]
        for k, part in some:
            np.matmul(head[part], self.m[k], out=p[part])
            p[part] += self.mb[k]
        p -= p.max(axis=1, keepdims=True)
        mine = p[own]
        np.exp(p, out=p)
        norm = p.sum(axis=1)
        out[order] += mine - np.log(norm)
        if grad is not None:
            p /= norm[:, None]
            p[own] -= 1
            back = np.empty_like(head)
            for k, part in some:
                grad.m[k] += head[part].T @ p[part]
                grad.mb[k] += p[part].sum(axis=0)
                np.matmul(p[part], self.m[k].T, out=back[part])
            slope[order] += back
        return out, slope

    def window(self, code: np.ndarray, fresh: np.ndarray, kind: np.ndarray, member: np.ndarray, h: np.ndarray, real: np.ndarray | None = None) -> tuple[float, np.ndarray, Network]:
        """Loss, last state and slopes over a window (lanes x steps); ``fresh`` steps start from an empty state, those not ``real`` only pad a lane's end.

        Steps beyond BACK are further windows: the state goes on, slopes do not go back.
        """
        (lanes, steps), kind_of = code.shape, self.flat.dtype
        grad = Network.empty(kind_of)
        span = min(steps, BACK)
        parts = steps // span
        # steps of all windows side by side, one after the other: what needs no neighbour in time is computed at once
        turned = lambda a: np.ascontiguousarray(a.reshape(lanes, parts, span).transpose(2, 1, 0))
        code, kind, member, fresh = (turned(a) for a in (code, kind, member, fresh))
        x, u, w = self.gates()
        zrc = np.take(x, code, axis=1, mode="clip")
        before, after = np.empty((2, span, parts, lanes, STATE), kind_of)
        before[0, 0] = h
        cut = fresh.any(axis=2)
        for k in range(parts):
            for t, any_fresh in enumerate(cut[:, k].tolist()):
                if any_fresh:
                    h = h * ~fresh[t, k, :, None]
                h = self.turn(zrc[:, t, k], h, u, w, after[t, k])
        before[0, 1:], before[1:] = after[-1, :-1], after[:-1]
        before[fresh] = 0
        rh = zrc[1] * before
        flat = after.reshape(-1, STATE)
        if real is None:
            log, slope = self.outputs(flat, kind.ravel(), member.ravel(), grad)
        else:
            some, slope = turned(real).ravel(), np.zeros_like(flat)
            log, slope[some] = self.outputs(flat[some], kind.ravel()[some], member.ravel()[some], grad)
        z, r, c, before, rh, slope = (a.reshape(span, -1, STATE) for a in (*zrc, before, rh, slope))
        fresh, cut = fresh.reshape(span, -1), cut.any(axis=1)
        back = np.zeros_like(before[0])
        slopes_x = np.empty((span, parts * lanes, 3 * STATE), kind_of)
        u, w = np.ascontiguousarray(self.u.T), np.ascontiguousarray(self.c.T)
        for t in reversed(range(span)):
            d_a, d_c = slopes_x[t, :, : 2 * STATE], slopes_x[t, :, 2 * STATE :]
            back += slope[t]
            kept = 1 - z[t]
            by = c[t] * c[t]
            np.subtract(1, by, out=by)
            by *= z[t]
            np.multiply(back, by, out=d_c)
            np.subtract(c[t], before[t], out=by)
            by *= z[t]
            by *= kept
            np.multiply(back, by, out=d_a[:, :STATE])
            d_rh = d_c @ w
            np.subtract(1, r[t], out=by)
            by *= rh[t]
            np.multiply(d_rh, by, out=d_a[:, STATE:])
            back *= kept
            d_rh *= r[t]
            back += d_rh
            back += d_a @ u
            if cut[t]:
                back *= ~fresh[t, :, None]
        every = slopes_x.reshape(-1, 3 * STATE)
        grad.c += rh.reshape(-1, STATE).T @ every[:, 2 * STATE :]
        grad.u += before.reshape(-1, STATE).T @ every[:, : 2 * STATE]
        add_rows(grad.x, code.ravel(), every)
        return -float(log.sum()), np.array(h), grad


def add_rows(to: np.ndarray, code: np.ndarray, rows: np.ndarray) -> None:
    """Add each row to the row of ``to`` that its code names."""
    order = np.argsort(code.astype(np.int16), kind="stable")
    codes = code[order]
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    # two neighbouring columns as one complex number: half as many sums
    pairs = np.take(rows, order, axis=0).view(np.result_type(rows, np.complex64))
    to[codes[first]] += np.add.reduceat(pairs, first, axis=0).view(rows.dtype)


class Adam:
    def __init__(self, net: Network):
        self.net, self.one, self.two, self.t = net, np.zeros_like(net.flat), np.zeros_like(net.flat), 0

    def update(self, slope: np.ndarray) -> None:
        self.t += 1
        self.one += 0.1 * (slope - self.one)
        self.two += 0.01 * (slope * slope - self.two)
        rate = RATE * np.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t)
        self.net.flat -= (rate * self.one / (np.sqrt(self.two) + 1e-8)).astype(self.net.flat.dtype)


def _stream(words: Words, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of a slice's tokens with an end after each row, and where each row starts (one more entry)."""
    first = words.first + np.arange(len(words.first))
    tokens = np.full(first[-1], END, np.uint64)
    tokens[np.arange(len(words.hash)) + words.doc] = words.hash
    return v.ranks(tokens), first


def _seen(rank: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the model sees before each token (the token ahead, or START), and which tokens are a row's first."""
    code = np.empty(len(rank), np.int16)
    code[1:] = Vocabulary.code(rank[:-1])
    fresh = np.zeros(len(rank), bool)
    fresh[first[:-1]] = True
    code[fresh] = START
    return code, fresh


def counts(train: DataFrame) -> DataFrame:
    """``word, n`` over all tokens; equal words of a task are added up before they travel."""

    def run(batches):
        def merged(held):
            word, at = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
            return word, np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64)

        def rows(held):
            word, n = merged(held)
            return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], ["word", "n"])

        held, size = [], 0
        for part in slices(batches):
            words = Words(part.column("text"), lower=True)
            word, n = np.unique(words.hash, return_counts=True)
            held.append((np.append(word, END), np.append(n, words.n)))
            size += len(word) + 1
            if size > _COUNTED:
                held = [merged(held)]
                size = len(held[0][0])
                if size > _COUNTED // 2:
                    yield rows(held)
                    held, size = [], 0
        if held:
            yield rows(held)
        release()

    return train.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(table: DataFrame) -> Vocabulary:
    sums = table.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct")).first()
    top = table.orderBy(F.desc("n"), "word").limit(TOP).toArrow()
    word, n = (top.column(c).to_numpy() for c in ("word", "n"))
    return Vocabulary.of(word.view(np.uint64), n.astype(np.int64), int(sums["total"] or 0), int(sums["distinct"]))


class Lanes:
    """Training of one partition: documents wait in lanes, whose next BACK tokens are a window."""

    def __init__(self, net: Network):
        self.net, self.adam, self.seen = net, Adam(net), 0
        self.held = [np.zeros((0, 4), np.int16)] * BATCH
        self.at, self.left = np.zeros(BATCH, np.int64), np.zeros(BATCH, np.int64)
        self.h = np.zeros((BATCH, STATE), np.float32)
        self.slope, self.tokens = np.zeros_like(net.flat), 0

    def read(self, words: Words, v: Vocabulary) -> None:
        """Each document of a slice goes to the lane with the least waiting; then all windows that fill enough lanes."""
        rank, first = _stream(words, v)
        code, fresh = _seen(rank, first)
        rows = np.stack([code, fresh, Vocabulary.output(rank), np.where(rank < HEAD, rank, 0) % MEMBERS], axis=1).astype(np.int16)
        new = [[self.held[k][self.at[k] :]] for k in range(BATCH)]
        least = [(n, k) for k, n in enumerate(self.left.tolist())]
        heapify(least)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            n, k = least[0]
            new[k].append(rows[a:b])
            heapreplace(least, (n + b - a, k))
        self.held, self.at = [np.concatenate(x) for x in new], np.zeros(BATCH, np.int64)
        self.left = np.array([len(x) for x in self.held])
        while (n := np.count_nonzero(self.left >= BACK)) and (n >= BATCH // 2 or self.left.sum() > WAITING):
            self.window(np.flatnonzero(self.left >= BACK))

    def finish(self) -> None:
        """What still waits; the last window of a lane is padded."""
        while len(some := np.flatnonzero(self.left)):
            # windows that no update parts are taken together, while half of the lanes go on
            left, turns = self.left[some], 1
            while self.tokens + np.minimum(left, turns * BACK).sum() < LEAST_UPDATE and 2 * np.count_nonzero(left > turns * BACK) >= len(some):
                turns += 1
            self.window(some, turns)
        if self.tokens:
            self.update()

    def window(self, some: np.ndarray, turns: int = 1) -> None:
        steps = turns * BACK
        rows, n = np.zeros((len(some), steps, 4), np.int16), np.minimum(self.left[some], steps)
        for row, (k, a, m) in enumerate(zip(some.tolist(), self.at[some].tolist(), n.tolist())):
            rows[row, :m] = self.held[k][a : a + m]
        real = None if n.min() == steps else np.arange(steps) < n[:, None]
        code, fresh, kind, member = (rows[:, :, k].astype(np.int64) for k in range(4))
        _, self.h[some], grad = self.net.window(code, fresh.astype(bool), kind, member, self.h[some], real)
        self.at[some] += n
        self.left[some] -= n
        self.slope += grad.flat
        self.tokens += int(n.sum())
        self.seen += int(n.sum())
        if self.tokens >= LEAST_UPDATE:
            self.update()

    def update(self) -> None:
        self.adam.update(self.slope / max(self.tokens, LEAST_UPDATE))
        self.slope[:], self.tokens = 0, 0


def train_network(docs: DataFrame, v: Vocabulary) -> Network:
    """Rounds of training in the partitions; after each, the mean of their weights by the tokens they saw."""
    net = Network.start(v)
    for turn in range(ROUNDS):
        sent = net.flat

        def learn(batches, sent=sent):
            own = Network(sent.copy())
            lanes = Lanes(own)
            for part in slices(batches):
                lanes.read(Words(part.column("text"), lower=True), v)
            lanes.finish()
            seen = lanes.seen
            if seen:
                at = np.arange(0, len(own.flat), CHUNK)
                weighted = own.flat.astype(np.float64) * seen
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.full(len(at), seen)), pa.array([weighted[a : a + CHUNK].tobytes() for a in at], pa.binary())], ["at", "seen", "sums"])
            del lanes
            release()

        def add(batches):
            sums: dict[int, tuple[int, np.ndarray]] = {}
            for part in batches:
                for at, seen, raw in zip(*(part.column(c).to_pylist() for c in ("at", "seen", "sums"))):
                    had = sums.get(at, (0, 0))
                    sums[at] = had[0] + seen, had[1] + np.frombuffer(raw)
            if sums:
                yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([s for s, _ in sums.values()], pa.int64()), pa.array([x.tobytes() for _, x in sums.values()], pa.binary())], ["at", "seen", "sums"])

        kind = "at long, seen long, sums binary"
        # equal texts are read in the same round, whatever the order of the rows
        own_docs = docs.where(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == turn)
        parts = own_docs.mapInArrow(learn, kind).repartition("at").mapInArrow(add, kind).collect()
        if not parts:
            return net
        flat = np.empty_like(sent)
        for r in parts:
            flat[r["at"] : r["at"] + CHUNK] = np.frombuffer(r["sums"]) / r["seen"]
        net = Network(flat)
    return net


def score_slice(words: Words, v: Vocabulary, net: Network) -> tuple[np.ndarray, np.ndarray]:
    """Per row, the natural log probability but for rare words' shares, and the ranks' stream."""
    rank, first = _stream(words, v)
    code, _ = _seen(rank, first)
    kind, member = (a.astype(np.int16) for a in (Vocabulary.output(rank), np.where(rank < HEAD, rank, 0) % MEMBERS))
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    begin, length = first[:-1][order], length[order]
    out = np.zeros(len(order))
    h = np.zeros((len(order), STATE), np.float32)
    waiting, owners, at, held = [], [], [], 0

    def flush():
        where = np.concatenate(at)
        log, _ = net.outputs(np.concatenate(waiting), kind[where], member[where])
        out[:] += np.bincount(np.concatenate(owners), log, len(out))

    alive = len(order)
    rows, gates = np.arange(len(order)), net.gates()
    for t in range(int(length[0]) if len(length) else 0):
        while length[alive - 1] <= t:
            alive -= 1
        where = begin[:alive] + t
        h = net.step(code[where], h[:alive], gates)[0]
        waiting.append(h)
        owners.append(rows[:alive])
        at.append(where)
        held += alive
        if held > 50_000:
            flush()
            waiting, owners, at, held = [], [], [], 0
    if held:
        flush()
    # words behind the head: their share of their class
    behind = rank >= HEAD
    shares = np.bincount(np.repeat(np.arange(len(first) - 1), np.diff(first))[behind], v.log_within[rank[behind]], len(out))
    log = np.empty(len(out))
    log[order] = out
    return log + shares, rank


def _marks(words: Words) -> np.ndarray:
    """A hash of each row's words and their order: it tells equal rows of one id from its other texts."""
    place = np.arange(len(words.hash)) - words.first[words.doc]
    sums = np.concatenate(([np.uint64(0)], np.cumsum(words.hash * (2 * place + 1).astype(np.uint64), dtype=np.uint64)))
    return mix(sums[words.first[1:]] - sums[words.first[:-1]])


def score(docs: DataFrame, held_out) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``; the model learns where the column ``held_out`` is false."""
    docs = texts(docs).withColumn("held_out", held_out)
    kind = docs.schema["doc_id"].dataType.simpleString()
    train = docs.where("NOT held_out").select("text")
    table = settle(counts(train), "lm-counts")
    v = vocabulary(table)
    net = train_network(train, v)
    log_all = np.log10(v.total + v.distinct + 1.0)
    log_rare = np.log10(float(v.rare_mass))

    def read(batches):
        for part in slices(batches, max_bytes=SCORE_BYTES):
            words = Words(part.column("text"), lower=True)
            log, rank = score_slice(words, v, net)
            first = words.first + np.arange(len(words.first))
            row = np.repeat(np.arange(words.n), np.diff(first))
            n = np.diff(first)
            known = rank >= 0
            base = np.bincount(row[known], np.log10(v.count[rank[known]] + 1.0), words.n) - n * log_all
            n_known = np.bincount(row[known], minlength=words.n)
            n_rare = n - n_known
            score = log / np.log(10) - n_rare * log_rare
            mark = _marks(words)
            # rare words by row
            hashes = np.full(len(rank), END, np.uint64)
            hashes[np.arange(len(words.hash)) + words.doc] = words.hash
            rare = np.flatnonzero(~known)
            pair = np.lexsort((hashes[rare], row[rare]))
            rare = rare[pair]
            new = np.concatenate(([True], (row[rare][1:] != row[rare][:-1]) | (hashes[rare][1:] != hashes[rare][:-1]))) if len(rare) else np.zeros(0, bool)
            spot = np.flatnonzero(new)
            times = np.diff(np.concatenate((spot, [len(rare)])))
            owner, word = row[rare][spot], hashes[rare][spot]
            # first the rows' own sums, then their rare words
            whose = np.concatenate((np.arange(words.n), owner))
            ids, held = (part.column(c).take(pa.array(whose)) for c in ("doc_id", "held_out"))
            own = lambda x, kind: pa.concat_arrays([pa.array(x, kind), pa.nulls(len(owner), kind)])
            rares = lambda x: pa.concat_arrays([pa.nulls(words.n, pa.int64()), pa.array(x, pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [ids, held, pa.array(mark[whose].view(np.int64)), own(n, pa.int64()), own(n_known, pa.int64()), own(base, pa.float64()), own(score, pa.float64()), rares(word.view(np.int64)), rares(times)],
                ["doc_id", "held_out", "mark", "n_tokens", "n_known", "base_score", "score", "word", "times"],
            )
        release()

    schema = f"doc_id {kind}, held_out boolean, mark long, n_tokens long, n_known long, base_score double, score double, word long, times long"
    rows = settle(docs.mapInArrow(read, schema), "lm-scores")
    # a document's row joins no word; equal rows of one id bring their rare words once each
    rare = rows.where("word IS NOT NULL").select("doc_id", "mark", "word", "times").join(table, "word", "left")
    rare = rare.groupBy("doc_id", "mark").agg(F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("log"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("seen"))
    own = rows.where("word IS NULL").drop("word", "times")
    copies = own.groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("copies"))
    key = lambda df: (F.coalesce(df["doc_id"].cast("string"), F.lit("")), df["mark"])
    sums = rare.select(*(c.alias(n) for c, n in zip(key(rare), ("key", "mark"))), "log", "seen")
    many = copies.select(*(c.alias(n) for c, n in zip(key(copies), ("key", "mark"))), "copies")
    out = own.withColumn("key", key(own)[0]).join(many, ["key", "mark"]).join(sums, ["key", "mark"], "left")
    log, seen = F.coalesce(F.col("log") / F.col("copies"), F.lit(0.0)), F.coalesce(F.expr("seen div copies"), F.lit(0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + seen).alias("n_known"), F.lit(v.total).cast("long").alias("train_tokens"),
        (F.col("base_score") + log).alias("base_score"), (F.col("score") + log).alias("score"),
    )
