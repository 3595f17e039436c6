"""Personal data by fixed patterns and a skip-chain conditional random field.

The fixed patterns report e-mail addresses, IP addresses, card numbers and
phone numbers; these spans are observed.  Every other mention that could be
one (a run of at least LEAST digits in groups, an address written with
``[at]``, or the name of an address of the document standing alone) is a node
whose label the field infers.  Potentials: features of the mention and of the
words beside it; the transition between neighbouring mentions; and one for
*skip* edges between mentions of a document that repeat the same string or
share their last digits or name, however far apart they stand.  Loopy belief
propagation passes messages until they settle, so a number that a pattern
found once is labelled alike where it stands in another format.

All other words can have no label but "none", which parts the chain: passing
messages among the mentions alone gives what passing them among all words
would.  Skip edges join neighbouring occurrences only, so a document with a
million equal mentions has a million edges and not their square.

Weights are learned by gradient steps on the field's likelihood, from at most
SAMPLE documents of up to SAMPLE_CHARS code points that hold a mention (chosen
by a hash; labels are what the fixed patterns find) and from composed
sentences.  A mention is reported (``like_<kind>``) from a marginal of SURE.

Spans are code points, end exclusive.  NULL and empty texts have no spans;
repeated rows are reported once each; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import by_slice, texts

KINDS = ("email", "ip", "card", "phone", "like_email", "like_ip", "like_card", "like_phone")
#: The fixed patterns.  Digit runs are taken whole (possessive): a match can only begin where a run does.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-".decode())

#: Mentions beside the fixed patterns.
LEAST = 7
NUMBER = re.compile(r"(?<![A-Za-z0-9])[+(]?[0-9]++(?:(?:\x20\(|\)\x20|[\x20.()/_-])[0-9]++)*+(?![A-Za-z0-9])")
SPELT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\[at\]|\(at\))\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?(?:\[dot\]|\(dot\))\x20?)[A-Za-z0-9-]++)++", re.I)
NAME = re.compile(r"(?<![A-Za-z0-9._%+@-])@?[A-Za-z0-9._%+-]++(?!@)")
WORD_BEFORE, WORD_AFTER = re.compile(r"([^\W\d_]+)[^\w]{0,3}$"), re.compile(r"[^\w]{0,3}([^\W\d_]+)")

#: Labels: none and the four kinds.  Edges: neighbours, equal strings, alike strings.
LABELS, EDGES = 5, 3
#: Hashed features; documents of the sample and their longest text; rounds of messages; the least change that goes on; marginal to report.
FEATURES, SAMPLE, SAMPLE_CHARS, ROUNDS, SETTLED, SURE = 1 << 13, 400, 20_000, 50, 1e-4, 0.9


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(int("0246813579"[int(d)]) for d in digits[-2::-2])) % 10 == 0


def digits_of(string: str) -> str:
    return "".join(c for c in string if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost addresses: the run before each ``@``, back to the end of the last match at most."""
    out, at, last = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        got = DOMAIN.match(text, at + 1) if start < at else None
        if got:
            out.append((start, got.end()))
            last = got.end()
        else:
            last = at + 1
        at = text.find("@", last)
    return out


def base(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns."""
    spans = [(a, 0, b) for a, b in emails(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p := part.lstrip("0")) < 4 and int(p or 0) < 256 for part in m[0].split("."))]
    for m in CARD.finditer(text):
        if 14 <= len(m[0]) and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            spans.append((m.start(), 2, m.end()))
    spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return sorted(spans)


@dataclass
class Mention:
    start: int
    end: int
    label: int  # 0 none, 1 + kind; of a pattern's span it is observed
    observed: bool
    same: str
    alike: str
    features: list[int]


def _feature(*parts: object) -> int:
    return zlib.crc32("|".join(map(str, parts)).encode("utf-8", "replace")) % FEATURES


def _features(text: str, start: int, end: int) -> list[int]:
    string, digits = text[start:end], digits_of(text[start:end])
    before = WORD_BEFORE.search(text[max(0, start - 24) : start])
    after = WORD_AFTER.match(text[end : end + 24])
    out = [_feature("bias"), _feature("before", before[1].lower() if before else ""), _feature("after", after[1].lower() if after else "")]
    if "@" in string or "at]" in string.lower() or "at)" in string.lower():
        return [*out, _feature("at"), _feature("spelt", "@" not in string)]
    groups = re.findall("[0-9]+", string)
    if len(digits) < len(string.strip("+( ")) // 2:
        return [*out, _feature("name")]
    shape = "-".join(str(min(len(g), 20)) for g in groups[:8])
    out += [_feature("n", min(len(digits), 24)), _feature("shape", shape), _feature("groups", min(len(groups), 9))]
    out += [_feature("first", string[0] if not string[0].isdigit() else "d"), _feature("parts", "".join(sorted(set(re.sub("[0-9]", "", string)))))]
    if 14 <= len(digits) <= 19:
        out.append(_feature("luhn", luhn(digits), min(len(set(digits)), 3)))
    if len(groups) == 4 and string.count(".") == 3:
        out.append(_feature("dotted", all(len(g) < 4 and int(g) < 256 for g in groups)))
    return out


def mentions(text: str, spans: list[tuple[int, int, int]]) -> list[Mention]:
    """The nodes of one text in order."""
    out, names, taken = [], set(), np.zeros(len(text) + 1, bool)
    for start, kind, end in spans:
        string = text[start:end].lower()
        if taken[start:end].any():  # a card number inside a phone number, say: the first span is the node
            continue
        taken[start:end] = True
        digits = digits_of(string)
        name = string.split("@")[0] if kind == 0 else ""
        if kind == 0 and re.search("[0-9._]", name):
            names.add(name)
        out.append(Mention(start, end, kind + 1, True, string if kind == 0 else digits, name if kind == 0 else digits[-LEAST:], _features(text, start, end)))
    found = [(m.start(), m.end(), digits_of(m[0]), "") for m in NUMBER.finditer(text)]
    found = [f for f in found if len(f[2]) >= LEAST]
    if "at]" in text or "at)" in text or "AT]" in text or "AT)" in text:
        found += [(m.start(), m.end(), "", re.split(r"\x20?[\[(]", m[0].lower())[0]) for m in SPELT.finditer(text)]
    if names:
        found += [(m.start(), m.end(), "", m[0].lower().lstrip("@")) for m in NAME.finditer(text) if m[0].lower().lstrip("@").rstrip(".") in names]
    for start, end, digits, name in found:
        if name:
            name = name.rstrip(".")
        if not taken[start:end].any():
            taken[start:end] = True
            out.append(Mention(start, end, 0, False, digits or text[start:end].lower(), digits[-LEAST:] or name, _features(text, start, end)))
    return sorted(out, key=lambda m: m.start)


@dataclass
class Graph:
    """The mentions of several texts: feature lists in sparse rows, edges as pairs of nodes with a type."""

    texts: np.ndarray
    owner: np.ndarray
    feature: np.ndarray
    label: np.ndarray
    observed: np.ndarray
    left: np.ndarray
    right: np.ndarray
    type: np.ndarray

    @classmethod
    def of(cls, documents: list[list[Mention]]) -> Graph:
        owner, feature, label, observed, edges, at, of_text = [], [], [], [], [], 0, []
        for number, nodes in enumerate(documents):
            last: dict[tuple[int, str], int] = {}
            for k, m in enumerate(nodes, at):
                of_text.append(number)
                owner += [k] * len(m.features)
                feature += m.features
                label.append(m.label)
                observed.append(m.observed)
                if k > at:
                    edges.append((k - 1, k, 0))
                other = last.get((1, m.same)) if m.same else None
                if other is not None:
                    edges.append((other, k, 1))
                near = last.get((2, m.alike)) if m.alike else None
                if near is not None and near != other:
                    edges.append((near, k, 2))
                last[1, m.same] = last[2, m.alike] = k
            at += len(nodes)
        pairs = np.array(edges, np.int64).reshape(-1, 3)
        return cls(np.array(of_text, np.int64), np.array(owner, np.int64), np.array(feature, np.int64), np.array(label, np.int64), np.array(observed, bool), pairs[:, 0], pairs[:, 1], pairs[:, 2])


@dataclass
class Field:
    unary: np.ndarray  # FEATURES x LABELS
    edge: np.ndarray  # EDGES x LABELS x LABELS

    def marginals(self, g: Graph, clamp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Node and edge marginals with the labels of ``clamp`` fixed, by loopy message passing."""
        n, m = len(g.label), len(g.left)
        score = np.zeros((n, LABELS))
        np.add.at(score, g.owner, self.unary[g.feature])
        fixed = np.flatnonzero(clamp)
        score[fixed] = -30.0
        score[fixed, g.label[fixed]] = 0.0
        score -= score.max(1, keepdims=True)
        # messages along 2m directed edges: left to right, then right to left
        source, target, back = np.concatenate([g.left, g.right]), np.concatenate([g.right, g.left]), np.concatenate([np.arange(m, 2 * m), np.arange(m)])
        joint = np.concatenate([self.edge[g.type], self.edge[g.type].transpose(0, 2, 1)])
        message = np.zeros((2 * m, LABELS))

        def beliefs() -> np.ndarray:
            return score + np.stack([np.bincount(target, message[:, c], n) for c in range(LABELS)], 1) if m else score

        for _ in range(ROUNDS if m else 0):
            sent = (beliefs()[source] - message[back])[:, :, None] + joint
            top = sent.max(1)
            new = top + np.log(np.exp(sent - top[:, None, :]).sum(1))
            new -= new.max(1, keepdims=True)
            change = np.abs(new - message).max()
            message = 0.5 * message + 0.5 * new
            if change < SETTLED:
                break
        node = np.exp(beliefs() - beliefs().max(1, keepdims=True))
        node /= node.sum(1, keepdims=True)
        if not m:
            return node, np.zeros((0, LABELS, LABELS))
        b = beliefs()
        both = (b[g.left] - message[m:])[:, :, None] + (b[g.right] - message[:m])[:, None, :] + joint[:m]
        both = np.exp(both - both.max((1, 2), keepdims=True))
        return node, both / both.sum((1, 2), keepdims=True)

    @classmethod
    def learn(cls, g: Graph, hidden: np.ndarray, known: np.ndarray, steps: int = 60, rate: float = 0.3, decay: float = 2e-3) -> Field:
        """Fit to the labels of ``known`` mentions; the labels of ``hidden`` ones are not seen while messages pass.

        The gradient of the likelihood is what is expected with all known
        labels fixed, less what is expected with the hidden ones free.
        """
        field = cls(np.zeros((FEATURES, LABELS)), np.zeros((EDGES, LABELS, LABELS)))
        # equal and alike mentions start out inclined to agree
        field.edge[1] = field.edge[2] = np.eye(LABELS)
        squares = [np.full_like(field.unary, 1e-6), np.full_like(field.edge, 1e-6)]
        for _ in range(steps):
            (node1, edge1), (node0, edge0) = field.marginals(g, known), field.marginals(g, known & ~hidden)
            step = [np.zeros_like(field.unary), np.zeros_like(field.edge)]
            np.add.at(step[0], g.feature, (node1 - node0)[g.owner])
            np.add.at(step[1], g.type, edge1 - edge0)
            step[1][1:] += step[1][1:].transpose(0, 2, 1)
            for w, d, s in zip((field.unary, field.edge), step, squares):
                d -= decay * w * len(g.label) / 100
                s += d * d
                w += rate * d / np.sqrt(s)
        return field


#: Sentences for composing: <phone> and the like stand for a random one (<local> without its area,
#: <name> an address without its host); <number> for a number that is none.
SENTENCES = (
    "Phone: <phone> or write to <email>.", "Call me at <phone> today", "tel. <phone>", "Fax <phone>, mobile <phone>", "Telefon <phone>",
    "Ruf uns an: <phone>", "Teléfono <phone>", "Téléphone : <phone>", "WhatsApp <phone>", "contact <email> or call <phone>",
    "Server <ip> answered", "host <ip> refused", "IP address <ip>", "from <ip> to <ip>", "card number <card> expires", "Visa <card>",
    "Kreditkarte <card>", "tarjeta <card>", "carte <card>", "order <number> shipped", "invoice no. <number>", "ISBN <number>", "ticket <number> closed",
    "the year <number> and <number>", "version <number> of", "id <number> and <number>", "about <number> people", "Bestellung <number>", "pedido <number>",
    "commande <number>", "tracking <number>", "serial <number>", "mail <email>", "E-Mail: <email>", "user <email> logged in", "timestamp <number>", "<number> <number> <number>",
    "<name> replied", "ask <name> about it", "@<name> and <email>", "as <name> said", "or simply <local>", "extension <local>", "<local> works too",
)


def composed(seed: int = 11, rounds: int = 12) -> list[list[Mention]]:
    """Mentions of random documents made of SENTENCES, with their true labels."""
    rng = random.Random(seed)
    run = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def phone(d: str) -> str:
        return rng.choice((f"+1 ({d[:3]}) {d[3:6]}-{d[6:]}", f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", f"+1{d}", f"{d[:3]} {d[3:6]} {d[6:]}"))

    def card(d: str) -> str:
        return rng.choice((d, f"{d[:4]} {d[4:8]} {d[8:12]} {d[12:]}", f"{d[:4]}-{d[4:8]}-{d[8:12]}-{d[12:]}", f"{d[:4]}.{d[4:8]}.{d[8:12]}.{d[12:]}"))

    def email(name: str) -> str:
        return rng.choice((f"{name}@mail.example.com", f"{name} [at] mail.example.com", f"{name}(at)mail(dot)example(dot)com", f"{name}@example.org"))

    out = []
    for _ in range(rounds * len(SENTENCES)):
        number = run(15)
        number = next(number + c for c in "0123456789" if luhn(number + c))
        values = {"phone": run(10), "card": number, "email": f"{rng.choice(('ann', 'bob', 'eva', 'max'))}.{run(2)}"}
        text, truth = "", []
        for sentence in rng.sample(SENTENCES, 3):
            for piece in re.split(r"(<\w+>)", sentence):
                kind = piece[1:-1] if piece.startswith("<") else ""
                if kind in ("phone", "card", "email"):
                    piece = {"phone": phone, "card": card, "email": email}[kind](values[kind])
                    truth.append((len(text), len(text) + len(piece), 1 + KINDS.index(kind)))
                elif kind == "local":
                    piece = f"{values['phone'][3:6]}-{values['phone'][6:]}"
                    truth.append((len(text), len(text) + len(piece), 4))
                elif kind == "name":
                    piece = values["email"]
                    truth.append((len(text), len(text) + len(piece), 1))
                elif kind == "ip":
                    piece = ".".join(str(rng.randrange(1, 255)) for _ in range(4))
                    truth.append((len(text), len(text) + len(piece), 2))
                elif kind == "number":
                    piece = run(rng.choice((7, 8, 9, 10, 11, 12, 13, 15, 18, 20)))
                    while luhn(piece):
                        piece = run(len(piece))
                text += piece
            text += rng.choice((". ", "\n", " "))
        nodes = mentions(text, base(text))
        for m in nodes:
            m.label = next((k for a, b, k in truth if a < m.end and m.start < b), 0)
        out.append(nodes)
    return out


def train(docs: DataFrame) -> Field:
    """The field, from a bounded sample of ``docs`` and composed documents."""
    rows = texts(docs).where(F.length("text").between(1, SAMPLE_CHARS) & F.col("text").rlike("[0-9]{7}|@")).withColumn("h", F.xxhash64("doc_id", "text"))
    least = [r["h"] for r in rows.select("h").orderBy("h").limit(SAMPLE).collect()]
    sample = [r["text"] for r in rows.where(F.col("h") <= least[-1]).limit(SAMPLE).collect()] if least else []
    found = [mentions(t, base(t)) for t in sorted(sample)]
    made = composed()
    graph = Graph.of(found + made)
    rng = np.random.default_rng(5)
    hidden = rng.random(len(graph.label)) < 0.5
    # in the corpus, a mention that no pattern finds is none unless it is linked to one that a pattern found
    linked = np.zeros(len(graph.label), bool)
    for k in np.flatnonzero(graph.type > 0):
        i, j = graph.left[k], graph.right[k]
        linked[i] |= graph.observed[j] and not graph.observed[i]
        linked[j] |= graph.observed[i] and not graph.observed[j]
    known = (graph.texts >= len(found)) | graph.observed | ~linked
    return Field.learn(graph, hidden, known)


def find(field: Field, documents: list[str | None]) -> list[list[tuple[int, int, int]]]:
    """Spans of each text: (start, kind as an index of KINDS, end), in order."""
    spans = [base(t) if t and ("@" in t or _DIGIT.search(t)) else [] for t in documents]
    nodes = [mentions(t, s) if t and (s or _LONG.search(t) or "[" in t or "(" in t) else [] for t, s in zip(documents, spans)]
    flat = [m for some in nodes for m in some]
    if not flat or all(m.observed for m in flat):
        return spans
    graph = Graph.of(nodes)
    node, _ = field.marginals(graph, graph.observed)
    label = node.argmax(1)
    sure = (label > 0) & ~graph.observed & (node.max(1) >= SURE)
    for k in np.flatnonzero(sure).tolist():
        spans[graph.texts[k]].append((flat[k].start, 3 + int(label[k]), flat[k].end))
    return [sorted(s) for s in spans]


_DIGIT = re.compile("[0-9]")
#: Without this many digits in close groups no number is a mention.
_LONG = re.compile(r"[0-9](?:[\x20.()/_-]{0,2}[0-9]){6}")


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, n_like, base_sha256, spans`` of every document."""
    docs = texts(docs)
    field = field or train(docs)

    def run(part):
        found = find(field, part.column("text").to_pylist())
        counts = [pa.array([sum(k == kind for _, k, _ in spans) for spans in found], pa.int64()) for kind in range(4)]
        like = pa.array([sum(k > 3 for _, k, _ in spans) for spans in found], pa.int64())
        digest = [hashlib.sha256(listed([s for s in spans if s[1] < 4]).encode()).hexdigest() for spans in found]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), *counts, like, pa.array(digest, pa.string()), pa.array([listed(s) for s in found], pa.string())],
            ["doc_id", *(f"n_{k}" for k in KINDS[:4]), "n_like", "base_sha256", "spans"],
        )

    key = docs.schema["doc_id"].dataType.simpleString()
    return by_slice(docs, run, f"doc_id {key}, " + ", ".join(f"n_{k} long" for k in (*KINDS[:4], "like")) + ", base_sha256 string, spans string")
