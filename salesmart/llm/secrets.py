"""Secret scanning: fixed patterns, and novelty against a primed zstandard dictionary.

The fixed patterns report assignments, access keys and hexadecimal strings.
Besides, every unbroken string that could be a credential (see CANDIDATE)
near a sensitive word is compressed with a zstandard dictionary primed with
the text around it and a list of common identifiers: what an author would
write there costs few marginal bytes, a random credential nearly all of its
information.  Candidates whose marginal bytes reach NOVEL of what random
characters of their alphabet hold are reported as ``novel``.  Other copies of
the candidate are taken out of the text that primes, so a credential that
stands many times is reported each time.  zstandard stores a short string's
letters as they are, so for strings without digits the order of the letters
decides besides: by the letter pairs of the same text and identifiers it must
cost more than words do (see letter_bits).  Candidates parted
only by line ends, quotes and the like are one run (the lines of a key): a
sensitive word near its ends counts for all of them.

Spans are code points, end exclusive.  NULL and empty texts have no spans;
repeated rows are reported once each.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from functools import lru_cache
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame

from salesmart.llm.common import by_slice, slices, texts

#: The fixed patterns, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "novel")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

#: A string that could be a credential, and what its neighbourhood must hold.
LEAST_NOVEL = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
SENSITIVE = re.compile(r"passw|secret|token|api.?key|credential|private|auth|bearer|access.?key|client.?id|signature|\bpwd\b|\bkey\b|://[^\s/]*:", re.A | re.I)
#: Code points on each side that are searched for sensitive words and prime the dictionary.
NEAR, AROUND = 48, 512
#: What may part the lines of one key; the short last line of a key block.
_GAP = r"""(?:[\s"'`,;#*>|.]|\\[nrt]?){1,32}"""
BETWEEN = re.compile(_GAP)
LAST_LINE = re.compile(rf"{_GAP}([A-Za-z0-9+/_=]{{1,15}})(?={_GAP}-+END\b)")
#: Marginal bytes as a share of the information of random characters, from which a string is reported.
NOVEL = 0.93
#: Alphabets that keys are written in, smallest first; symbols come on top.
ALPHABETS = ((16, re.compile(r"[0-9A-F]*|[0-9a-f]*")), (22, re.compile(r"[0-9A-Fa-f]*")), (32, re.compile(r"[A-Z2-7]*|[a-z2-7]*")), (36, re.compile(r"[A-Z0-9]*|[a-z0-9]*")))
_SYMBOL = re.compile(r"[+/_=-]")
_LETTERS = re.compile(r"[A-Z]*[a-z]+|[A-Z]+")
#: Bits of a letter from which a string without digits is no word (a random letter holds 4.7 and costs more, since
#: the pairs are not its own); what a pair of letters that was never seen counts as.
LETTER_BITS, UNSEEN = log2(26) + 0.5, 0.1
#: Identifiers that code and configuration commonly hold; they prime every dictionary.
IDENTIFIERS = (
    b"access_key api_key apikey application/json auth_token authorization authentication basic bearer base64 "
    b"certificate client_id client_secret config configuration connection_string content-type credential database "
    b"default_value description development environment example.com function github https://www. identifier import "
    b"index.html javascript localhost namespace organization parameters passphrase password placeholder private_key "
    b"production public_key refresh_token repository response_type return_value secret_access_key secret_key "
    b"session_id signature staging_environment test_user timestamp username your_api_key_here your_password_here "
    b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/ xxxxxxxxxxxxxxxx0000000000000000"
)

_TO_HEX = bytes(104 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_TO_CANDIDATE = bytes(120 if re.match(r"[A-Za-z0-9+/_=-]", chr(b)) and b < 128 else 32 for b in range(256))


def novelty(candidate: bytes, around: bytes) -> float:
    """Marginal compressed bytes of ``candidate`` given ``around``, for each of its bytes."""
    import zstandard

    primed = zstandard.ZstdCompressionDict(IDENTIFIERS + b" " + around, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    coder = zstandard.ZstdCompressor(level=6, dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False)
    plain = len(coder.compress(b""))
    return (len(coder.compress(candidate)) - plain) / len(candidate)


def information(candidate: str) -> float:
    """Bytes that each character of ``candidate`` holds if it is random in its alphabet."""
    bare = _SYMBOL.sub("", candidate)
    size = next((n for n, kind in ALPHABETS if kind.fullmatch(bare)), 62)
    return log2(size + len(set(_SYMBOL.findall(candidate)))) / 8


def runs(text: str) -> list[list[re.Match]]:
    """The candidates of ``text`` in runs of adjacent ones."""
    out: list[list[re.Match]] = []
    for m in CANDIDATE.finditer(text):
        if out and BETWEEN.fullmatch(text, out[-1][-1].end(), m.start()):
            out[-1].append(m)
        else:
            out.append([m])
    return out


def sensitive(text: str, start: int, end: int) -> bool:
    """Whether a sensitive word lies near ``start:end``."""
    return bool(SENSITIVE.search(text[max(0, start - NEAR) : start]) or SENSITIVE.search(text[end : end + NEAR]))


@lru_cache(maxsize=1)
def _identifier_pairs() -> Counter:
    return letter_pairs(IDENTIFIERS.decode())


def letter_pairs(text: str) -> Counter:
    """How often each pair of neighbouring letters occurs in the words of ``text``, in lower case; a capital begins a word."""
    return Counter(pair for word in _LETTERS.findall(text) for pair in map("".join, zip(word.lower(), word[1:].lower())))


def letter_bits(string: str, around: str) -> float:
    """Bits that each letter after another one in ``string`` costs, by the letter pairs of ``around`` and the identifiers."""
    pairs = letter_pairs(string)
    known = letter_pairs(around)
    known.update(_identifier_pairs())
    first: Counter = Counter()
    for pair, n in known.items():
        first[pair[0]] += n
    bits = sum(n * -log2((known[pair] + UNSEEN) / (first[pair[0]] + 26 * UNSEEN)) for pair, n in pairs.items())
    return bits / max(pairs.total(), 1)


def plausible(string: str, around: str) -> bool:
    """Credentials mix digits with letters, or have letters in no order that words have."""
    digits = sum(c.isdigit() for c in string)
    letters = sum(c.isalpha() for c in string)
    if digits:
        turns = sum(a.isdigit() != b.isdigit() or a.islower() != b.islower() for a, b in zip(string, string[1:]))
        return letters >= 2 and turns * 5 >= len(string)
    return letters * 2 >= len(string) and letter_bits(string, around) >= LETTER_BITS


def disjoint(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of what ``spans`` (in order) cover, overlapping ones joined."""
    starts: list[int] = []
    ends: list[int] = []
    for start, _, end in spans:
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def find(text: str | None) -> list[tuple[int, int, int]]:
    """Spans of one text: (start, kind as an index of KINDS, end), in order."""
    if not text:
        return []
    spans: list[tuple[int, int, int]] = []
    raw = text.encode("utf-8", "surrogatepass")
    low = raw.lower()
    if b"passw" in low or b"secret" in low or b"token" in low or (b"api" in low and b"key" in low):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if b"AKIA" in raw:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    if b"h" * LEAST_HEX in raw.translate(_TO_HEX):
        spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if b"x" * LEAST_NOVEL in raw.translate(_TO_CANDIDATE):
        starts, ends = disjoint(sorted(spans))
        for run in runs(text):
            whole, reported = sensitive(text, run[0].start(), run[-1].end()), False
            for m in run:
                start, end = m.span()
                at = bisect_right(ends, start)  # the first that ends behind the candidate's start
                if at < len(starts) and starts[at] < end:
                    continue
                if not whole and not sensitive(text, start, end):
                    continue
                around = (text[max(0, start - AROUND) : start] + " " + text[end : end + AROUND]).replace(m[0], " ")
                if not plausible(m[0], around):
                    continue
                if novelty(m[0].encode(), around.encode("utf-8", "replace")) >= NOVEL * information(m[0]):
                    spans.append((start, 3, end))
                    reported = True
            if reported and whole and (last := LAST_LINE.match(text, run[-1].end())):
                spans.append((last.start(1), 3, last.end(1)))
    return sorted(spans)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans`` of every document."""
    docs = texts(docs)

    def run(part):
        found = [find(t) for t in part.column("text").to_pylist()]
        counts = [pa.array([sum(k == kind for _, k, _ in spans) for spans in found], pa.int64()) for kind in range(len(KINDS))]
        base = [hashlib.sha256(listed([s for s in spans if s[1] < 3]).encode()).hexdigest() for spans in found]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), *counts, pa.array(base, pa.string()), pa.array([listed(s) for s in found], pa.string())], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return by_slice(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def redact_text(text: str | None, mask: str = "[SECRET]") -> str | None:
    """``text`` with every span replaced by ``mask`` (overlapping spans by one)."""
    out, at = [], 0
    spans = find(text)
    if not spans:
        return text
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """All columns of ``docs``, in order, with the secrets of ``text`` masked and its ``length`` (if there) following."""
    schema = docs.schema

    def run(batches):
        for part in slices(batches, text):
            at = part.schema.get_field_index(text)
            before = part.column(at).to_pylist()
            after = [redact_text(t) for t in before]
            changed = [k for k, (a, b) in enumerate(zip(before, after)) if a != b]
            if changed:
                part = part.set_column(at, part.schema.field(at), pa.array(after, part.schema.field(at).type))
                size = part.schema.get_field_index(length)
                if size >= 0 and pa.types.is_integer(part.schema.field(size).type):
                    sizes = part.column(size).to_pylist()
                    for k in changed:
                        sizes[k] = len(after[k])
                    part = part.set_column(size, part.schema.field(size), pa.array(sizes, part.schema.field(size).type))
            yield part

    return docs.mapInArrow(run, schema)
