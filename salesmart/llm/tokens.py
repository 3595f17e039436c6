"""Token ids of many texts, with a bounded store of repeated chunks.

Byte-level BPE never joins a character with white space that follows it, nor a
letter with punctuation that follows it, so a text may be cut there and the
parts encoded alone.  Most parts (a word with the white space before it)
repeat.  Cutting, looking up and putting the ids together are array operations
on the UTF-8 bytes of a slice; only chunks that are not known yet reach the
tokenizer.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from salesmart.llm.common import word_hashes, worker_store

#: Known chunks at most, the longest chunk that is kept (bytes), and characters encoded in one call.
CACHED, LONGEST, AT_ONCE = 1_000_000, 64, 2_000
#: ASCII white space, letters, and the punctuation that is cut off after a letter.
_BLANK, _LETTER, _POINT = (np.zeros(256, bool) for _ in range(3))
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LETTER[65:91] = _LETTER[97:123] = True
_POINT[list(b".,;:!?")] = True
#: Unicode's White_Space characters beyond ASCII: no cut right after one.
_WIDE = {c.encode() for c in "\x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))}
_SPLITS = re.compile(r"[A-Za-z][.,;:!?]|\s")


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``start[k], start[k] + 1, …`` of ``size[k]`` values for every ``k``, one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column (NULL: none) and the bounds of its rows."""
    column = pc.fill_null(column.cast(pa.large_string()), "") if column.null_count else column.cast(pa.large_string())
    n = len(column)
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


class Store:
    """Known chunks: their bytes and ids, found by a hash of the bytes and compared in full."""

    def __init__(self):
        self.hash = np.zeros(0, np.uint64)
        self.bytes, self.ids = np.zeros(0, np.uint8), np.zeros(0, np.uint32)
        self.byte_at, self.byte_n, self.id_at, self.id_n = (np.zeros(0, np.int64) for _ in range(4))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash, or -1."""
        if not len(self.hash):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        return np.where(self.hash[at] == hashes, at, -1)

    def joined(self, places: np.ndarray | None, other: Store) -> Store:
        """The chunks at ``places`` (None: all) and those of ``other``, by hash."""
        if places is not None and len(places) < len(self.hash):
            kept = Store()
            kept.hash, kept.byte_n, kept.id_n = self.hash[places], self.byte_n[places], self.id_n[places]
            kept.bytes, kept.ids = self.bytes[ranges(self.byte_at[places], kept.byte_n)], self.ids[ranges(self.id_at[places], kept.id_n)]
            kept.byte_at, kept.id_at = np.cumsum(kept.byte_n) - kept.byte_n, np.cumsum(kept.id_n) - kept.id_n
        else:
            kept = self
        out = Store()
        hashes = np.concatenate([kept.hash, other.hash])
        order = np.argsort(hashes, kind="stable")
        out.hash = hashes[order]
        for name, shift in (("byte_at", len(kept.bytes)), ("id_at", len(kept.ids)), ("byte_n", 0), ("id_n", 0)):
            setattr(out, name, np.concatenate([getattr(kept, name), getattr(other, name) + shift])[order])
        out.bytes, out.ids = np.concatenate([kept.bytes, other.bytes]), np.concatenate([kept.ids, other.ids])
        return out


class Encoder:
    """``tokenizers`` ids of whole texts.

    As a plain call does, the string of a special token gives its id; with
    ``plain`` it is ordinary text.  If a special token holds a place where
    texts are cut, they are not cut there (``cuts`` is then False).
    """

    def __init__(self, path: str, cached: int = CACHED, plain: bool = False):
        self.cached = cached
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cuts = plain or not any(_SPLITS.search(t) for t in special)
        # a byte-level token's text has one character for each byte
        self.size = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            self.size[number] = len(token)
        self.known = Store()

    def _cuts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where chunks begin (each row's first byte included)."""
        if not len(data):
            return np.zeros(0, np.int64)
        if not self.cuts:
            return np.unique(bounds[:-1][np.diff(bounds) > 0])
        blank = _BLANK[data]
        begins = np.zeros(len(data), bool)
        begins[1:] = (blank[1:] & ~blank[:-1]) | (_POINT[data[1:]] & _LETTER[data[:-1]])
        # a wide blank before a blank belongs to the same run
        for at in np.flatnonzero(begins[1:] & (data[:-1] >= 0x80)).tolist():
            if bytes(data[max(0, at - 1) : at + 1]) in _WIDE or bytes(data[max(0, at - 2) : at + 1]) in _WIDE:
                begins[at + 1] = False
        begins[bounds[:-1][np.diff(bounds) > 0]] = True
        return np.flatnonzero(begins)

    def _encode(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks, one after the other, and how many each has."""
        count = np.zeros(len(chunks), np.int64)
        parts: list[np.ndarray | None] = [None] * len(chunks)
        held: list[int] = []
        alone: list[int] = []
        size = 0
        runs: list[list[int]] = []
        for k, chunk in enumerate(chunks):
            # a run of chunks that begin with a blank and end without is one text, cut by its tokens' sizes
            if chunk[0] in b" \t\n\r\x0b\x0c" and chunk[-1] < 0x80 and chunk[-1] not in b" \t\n\r\x0b\x0c":
                held.append(k)
                size += len(chunk)
                if size >= AT_ONCE:
                    runs.append(held)
                    held, size = [], 0
            else:
                alone.append(k)
        if held:
            runs.append(held)
        joined = [b"".join(chunks[k] for k in run).decode() for run in runs]
        for run, got in zip(runs, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(got.ids, np.uint32)
            ends = np.cumsum([len(chunks[k]) for k in run])
            cuts = np.searchsorted(np.cumsum(self.size[ids]), ends, "left") + 1
            begin = np.concatenate(([0], cuts[:-1]))
            count[run] = cuts - begin
            for k, a, b in zip(run, begin.tolist(), cuts.tolist()):
                parts[k] = ids[a:b]
        for k, got in zip(alone, self.tokenizer.encode_batch_fast([chunks[k].decode() for k in alone], add_special_tokens=False)):
            parts[k] = np.array(got.ids, np.uint32)
            count[k] = len(parts[k])
        return np.concatenate([*parts, np.zeros(0, np.uint32)]), count

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a column's texts (NULL: empty), one after the other, and how many each has."""
        data, bounds = text_bytes(column)
        start = self._cuts(data, bounds)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(bounds) - 1, np.int64)
        end = np.append(start[1:], len(data))
        size = end - start
        _, first, chunk = np.unique(word_hashes(data, start, end), return_index=True, return_inverse=True)
        # chunks of one hash are one chunk only if their bytes agree
        like = start[first][chunk]
        differs = size != size[first][chunk]
        even = np.flatnonzero(~differs)
        equal = data[ranges(start[even], size[even])] == data[ranges(like[even], size[even])]
        differs[even] = ~np.logical_and.reduceat(equal, np.cumsum(size[even]) - size[even])
        odd = np.flatnonzero(differs)
        if len(odd):
            first, chunk = np.append(first, odd), chunk.copy()
            chunk[odd] = np.arange(len(first) - len(odd), len(first))
        a, n = start[first], size[first]
        hashes = word_hashes(data, a, a + n)
        at = self.known.find(hashes)
        known = np.flatnonzero(at >= 0)
        fits = self.known.byte_n[at[known]] == n[known]
        at[known[~fits]] = -1
        known = known[fits]
        if len(known):
            equal = data[ranges(a[known], n[known])] == self.known.bytes[ranges(self.known.byte_at[at[known]], n[known])]
            at[known[~np.logical_and.reduceat(equal, np.cumsum(n[known]) - n[known])]] = -1
        fresh = np.flatnonzero(at < 0)
        raw = data.tobytes()
        new_ids, new_n = self._encode([raw[p : p + q] for p, q in zip(a[fresh].tolist(), n[fresh].tolist())])
        # each distinct chunk's ids: in the store, or behind them among the new ones
        where, many = np.empty(len(first), np.int64), np.empty(len(first), np.int64)
        old = np.flatnonzero(at >= 0)
        where[old], many[old] = self.known.id_at[at[old]], self.known.id_n[at[old]]
        where[fresh], many[fresh] = np.cumsum(new_n) - new_n + len(self.known.ids), new_n
        out = np.concatenate([self.known.ids, new_ids])[ranges(where[chunk], many[chunk])]
        per_chunk = np.concatenate(([0], np.cumsum(many[chunk])))
        edge = per_chunk[np.searchsorted(start, bounds)]
        self._learn(data, a[fresh], n[fresh], hashes[fresh], new_ids, new_n, at[old])
        return out, np.diff(edge)

    def _learn(self, data: np.ndarray, a: np.ndarray, n: np.ndarray, hashes: np.ndarray, ids: np.ndarray, count: np.ndarray, used: np.ndarray) -> None:
        some = np.flatnonzero((n <= LONGEST) & (self.known.find(hashes) < 0))
        _, once = np.unique(hashes[some], return_index=True)
        some = some[once]
        new = Store()
        new.hash, new.byte_n, new.id_n = hashes[some], n[some], count[some]
        new.bytes, new.ids = data[ranges(a[some], n[some])], ids[ranges(np.cumsum(count)[some] - count[some], count[some])]
        new.byte_at, new.id_at = np.cumsum(new.byte_n) - new.byte_n, np.cumsum(new.id_n) - new.id_n
        # what this slice uses is what repeats
        full = len(self.known.hash) + len(some) > self.cached
        self.known = self.known.joined(np.unique(used) if full else None, new)

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        ids, count = self.ids(pa.array(texts, pa.string()))
        raw, ends = ids.astype("<u4").tobytes(), np.cumsum(count)
        return [raw[4 * (e - c) : 4 * e] for e, c in zip(ends.tolist(), count.tolist())]


def encoder(path: str, cached: int = CACHED, plain: bool = False) -> Encoder:
    """This worker's encoder: built once, its known chunks serve later tasks too."""
    key = (path, cached, plain)
    store = worker_store()
    if key not in store:
        store[key] = Encoder(path, cached, plain)
    return store[key]


def with_end(ids: np.ndarray, count: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """``ids`` and ``count`` with the id ``end`` after each text."""
    total = np.cumsum(count)
    return np.insert(ids, total, np.uint32(end)), count + 1
