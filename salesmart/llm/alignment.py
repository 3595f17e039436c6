"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers' tokens are rows of token-byte incidence matrices in
compressed sparse rows (``CSR``).  The product of A with the transpose of B,
row by row as Gustavson computes it, holds for each pair of overlapping tokens
the bytes they share: its entries are the overlap links.  Where tokens of both
end at one byte, a group ends; tokens are rows of token-group matrices as
well, and the same product of those gives the shared-group links.  Only their
number is asked for here, and the product's symbolic pass gives it without
writing the entries, however large a group is.

The count of a pair of ids is the number of documents that hold it linked.
A slice of documents keeps its own table of distinct pairs, so a pair meets
the counts of the corpus once for each slice and not once for each document or
link; hot pairs are summed in each task before the shuffle, and the join of
the slices' pairs with the counts is dealt by pair, where AQE splits hot ones.

Texts that are NULL or empty, or whose tokens' bytes do not join to a blank
and the text, have no tokens: zeros and an empty digest.  Repeated rows are
documents of their own; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import discard, release, scratch, settle, slices, texts, worker_store
from salesmart.llm.tokens import encoder, ranges, text_bytes

#: A's id is the upper, B's the lower half of a pair.
SHIFT = 32
#: Bytes of text that are aligned at once.
SLICE = 1 << 20
#: Chunks of text whose ids a worker remembers.
CACHED = 600_000
#: Entries that a product expands at once.
EXPANDED = 1 << 22


@dataclass
class CSR:
    """A sparse matrix: the columns of row ``i`` are ``indices[indptr[i]:indptr[i + 1]]``, ascending."""

    indptr: np.ndarray
    indices: np.ndarray
    columns: int

    @classmethod
    def of_ranges(cls, starts: np.ndarray, stops: np.ndarray, columns: int) -> CSR:
        """Row ``i`` holds the columns ``starts[i]`` to ``stops[i] - 1``."""
        size = stops - starts
        indptr = np.concatenate(([0], np.cumsum(size)))
        return cls(indptr, np.arange(indptr[-1]) - np.repeat(indptr[:-1] - starts, size), columns)

    @classmethod
    def of_labels(cls, labels: np.ndarray, columns: int) -> CSR:
        """Row ``i`` holds the one column ``labels[i]``."""
        return cls(np.arange(len(labels) + 1), labels, columns)

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    def transposed(self) -> CSR:
        row = np.repeat(np.arange(self.rows), np.diff(self.indptr))
        order = np.argsort(self.indices, kind="stable")
        return CSR(np.concatenate(([0], np.cumsum(np.bincount(self.indices, minlength=self.columns)))), row[order], self.rows)

    def expanded(self, other: CSR) -> np.ndarray:
        """The multiplications that each row of the product takes (the symbolic pass)."""
        per = np.diff(other.indptr)[self.indices]
        total = np.concatenate(([0], np.cumsum(per)))
        return total[self.indptr[1:]] - total[self.indptr[:-1]]

    def product(self, other: CSR) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows, columns and values of ``self`` times ``other`` (all entries one), in blocks of whole rows.

        Row ``i`` of the product is the sum of the rows of ``other`` that the
        columns of row ``i`` of ``self`` name.
        """
        work = np.concatenate(([0], np.cumsum(self.expanded(other))))
        a = 0
        while a < self.rows:
            b = max(a + 1, int(np.searchsorted(work, work[a] + EXPANDED, "right")) - 1)
            inner = self.indices[self.indptr[a] : self.indptr[b]]
            row = np.repeat(np.arange(a, b), np.diff(self.indptr[a : b + 1]))
            many = other.indptr[inner + 1] - other.indptr[inner]
            at = np.repeat(other.indptr[inner] - np.cumsum(many) + many, many) + np.arange(many.sum())
            row, column = np.repeat(row, many), other.indices[at]
            key = row * other.columns + column
            if len(key) and (key[1:] < key[:-1]).any():
                key = np.sort(key)
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
            yield key[first] // other.columns, key[first] % other.columns, np.diff(np.append(first, len(key)))
            a = b


def _piece_bytes(path: str) -> tuple[object, list[bytes]]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(k) else piece.replace("▁", " ").encode())
    return model, out


def _unicode_bytes() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable Latin-1 stands for itself, the rest follows from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class Bytes:
    """The bytes of every token of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(x) for x in tokens], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def differ(self, ids: np.ndarray, count: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Which rows' tokens do not join to the row's bytes."""
        total = np.concatenate(([0], np.cumsum(self.size[ids])))
        ends = np.cumsum(count)
        size = total[ends] - total[ends - count]
        bad = size != np.diff(bounds)
        good = np.flatnonzero(~bad & (size > 0))
        if len(good):
            mine = ids[ranges((ends - count)[good], count[good])]
            equal = self.data[ranges(self.at[mine], self.size[mine])] == data[ranges(bounds[good], size[good])]
            bad[good[~np.logical_and.reduceat(equal, np.cumsum(size[good]) - size[good])]] = True
        return bad


class Pair:
    """Tokenizers A (byte-level BPE, with a blank before the text) and B (pieces)."""

    def __init__(self, a: str, b: str):
        self.a = encoder(a, CACHED, plain=True)
        self.model, pieces = _piece_bytes(b)
        table = _unicode_bytes()
        tokens = [b""] * len(self.a.size)
        for token, number in self.a.tokenizer.get_vocab().items():
            tokens[number] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
        self.a_bytes, self.b_bytes = Bytes(tokens), Bytes(pieces)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and numbers of them for each text, and those of B; none where the bytes do not join to the blank and the text."""
        some = pc.fill_null(pc.greater(pc.binary_length(column), 0), False)
        full = pc.if_else(some, pc.binary_join_element_wise(pa.scalar("", column.type), column, " "), pa.scalar("", column.type))
        data, bounds = text_bytes(full)
        a, n_a = self.a.ids(full)
        listed = self.model.encode([t or "" for t in column.to_pylist()], num_threads=1)
        n_b = np.fromiter(map(len, listed), np.int64, len(listed))
        b = np.fromiter(chain.from_iterable(listed), np.int64, int(n_b.sum()))
        bad = self.a_bytes.differ(a, n_a, data, bounds) | self.b_bytes.differ(b, n_b, data, bounds)
        if bad.any():
            a, b = a[np.repeat(~bad, n_a)], b[np.repeat(~bad, n_b)]
            n_a, n_b = np.where(bad, 0, n_a), np.where(bad, 0, n_b)
        return a.astype(np.int64), n_a, b, n_b


def pair(a: str, b: str) -> Pair:
    """This worker's pair of tokenizers."""
    store = worker_store()
    if (a, b) not in store:
        store[a, b] = Pair(a, b)
    return store[a, b]


@dataclass
class Aligned:
    """A slice's tokens, groups and links, documents one after the other."""

    a: np.ndarray
    b: np.ndarray
    a_doc: np.ndarray
    b_doc: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    n_groups: int
    link_a: np.ndarray
    link_b: np.ndarray

    @classmethod
    def of(cls, tokens: Pair, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> Aligned:
        size_a, size_b = tokens.a_bytes.size[a], tokens.b_bytes.size[b]
        stop_a, stop_b = np.cumsum(size_a), np.cumsum(size_b)
        total = int(stop_a[-1]) if len(stop_a) else 0
        # documents end both tokens, so no token, group or link reaches into another one
        both = np.intersect1d(stop_a, stop_b, assume_unique=True)
        by_byte = CSR.of_ranges(stop_b - size_b, stop_b, total).transposed()
        rows, columns = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for row, column, _ in CSR.of_ranges(stop_a - size_a, stop_a, total).product(by_byte):
            rows.append(row)
            columns.append(column)
        doc = np.arange(len(n_a))
        return cls(a, b, np.repeat(doc, n_a), np.repeat(doc, n_b), np.searchsorted(both, stop_a), np.searchsorted(both, stop_b), len(both), np.concatenate(rows), np.concatenate(columns))

    def shared(self) -> np.ndarray:
        """How many B tokens share each A token's group: the row sizes of the group product."""
        return CSR.of_labels(self.a_group, self.n_groups).expanded(CSR.of_labels(self.b_group, self.n_groups).transposed())

    def digests(self, n: int) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2`` of each document ('' without tokens)."""
        many = len(self.a) + len(self.b)
        if not many:
            return [""] * n
        # place of each token in the text: its group's A tokens, then its B tokens
        at_a = np.arange(len(self.a)) + np.searchsorted(self.b_group, self.a_group, "left")
        at_b = np.arange(len(self.b)) + np.searchsorted(self.a_group, self.b_group, "right")
        ids, group, side, doc = (np.empty(many, np.int64) for _ in range(4))
        for at, values in ((at_a, (self.a, self.a_group, 0, self.a_doc)), (at_b, (self.b, self.b_group, 1, self.b_doc))):
            for out, x in zip((ids, group, side, doc), values):
                out[at] = x
        mark = np.full(many, ord(","), np.uint8)
        mark[:-1][side[1:] != side[:-1]] = ord("|")
        mark[:-1][group[1:] != group[:-1]] = ord(";")
        digits = np.ones(many, np.int64)
        for k in range(1, 10):
            digits += ids >= 10**k
        ends = np.cumsum(digits + 1)
        text = np.zeros(ends[-1], np.uint8)
        text[ends - 1] = mark
        rest = ids.copy()
        for k in range(int(digits.max())):
            some = digits > k
            text[ends[some] - 2 - k] = rest[some] % 10 + 48
            rest //= 10
        stop = np.concatenate(([0], ends))[np.searchsorted(doc, np.arange(n + 1))]
        view = memoryview(text.tobytes())
        return [hashlib.sha256(view[p : q - 1]).hexdigest() if q > p else "" for p, q in zip(stop[:-1].tolist(), stop[1:].tolist())]


def _narrow(n: int) -> str:
    return "<u2" if n <= 1 << 16 else "<u4"


def links(docs: DataFrame, a: str, b: str) -> DataFrame:
    """One row per document: sizes, digest, and its links as places in its slice's table of pairs.

    The first row of a slice carries that table: ``pairs`` (ascending) and
    ``held``, how many of the slice's documents hold each.
    """
    docs = texts(docs)
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        for part in slices(batches, max_bytes=SLICE):
            n = part.num_rows
            tokens = pair(a, b)
            got = Aligned.of(tokens, *tokens.encode(part.column("text")))
            doc = got.a_doc[got.link_a]
            pairs, at = np.unique(got.a[got.link_a] << SHIFT | got.b[got.link_b], return_inverse=True)
            once = np.unique(doc * (len(pairs) + 1) + at) % (len(pairs) + 1)
            held = np.bincount(once, minlength=len(pairs))
            begin = np.searchsorted(doc, np.arange(n + 1))
            places = at.astype(_narrow(len(pairs)))
            group_doc = got.a_doc[np.searchsorted(got.a_group, np.arange(got.n_groups))] if got.n_groups else np.zeros(0, np.int64)
            count = lambda x, w=None: pa.array(np.bincount(x, w, n).astype(np.int64))
            first = [pairs.astype("<i8").tobytes(), *[None] * (n - 1)], [held.astype("<i8").tobytes(), *[None] * (n - 1)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array(np.full(n, task << 32 | number)), count(got.a_doc), count(got.b_doc), count(group_doc),
                    count(doc), count(got.a_doc, got.shared()), pa.array(got.digests(n), pa.string()),
                    pa.array([places[p:q].tobytes() for p, q in zip(begin[:-1].tolist(), begin[1:].tolist())], pa.binary()), *(pa.array(x, pa.binary()) for x in first),
                ],
                ["doc_id", "slice", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256", "links", "pairs", "held"],
            )
            number += 1
        release(keep=True)

    return docs.mapInArrow(run, f"doc_id {key}, slice long, n_a long, n_b long, n_groups long, n_links long, n_shared long, groups_sha256 string, links binary, pairs binary, held binary")


def _unpacked(aligned: DataFrame, held: bool) -> DataFrame:
    """``pair, held`` of every task, or ``slice, pair`` of every slice."""
    names = ["pair", "held"] if held else ["slice", "pair"]

    def run(batches):
        known: dict[int, int] = {}
        for batch in batches:
            for number, pairs, count in zip(*(batch.column(c).to_pylist() for c in ("slice", "pairs", "held"))):
                pairs, count = np.frombuffer(pairs, "<i8"), np.frombuffer(count, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(count)] if held else [pa.array(np.full(len(pairs), number)), pa.array(pairs)], names)
        known.clear()

    return aligned.where(F.col("pairs").isNotNull()).select("slice", "pairs", "held").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n_docs``: the documents of the corpus that hold each pair linked."""
    return _unpacked(aligned, True).groupBy("pair").agg(F.sum("held").alias("n_docs"))


def align(docs: DataFrame, a: str, b: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum, groups_sha256`` of every document."""
    spark = docs.sparkSession
    aligned, one = scratch(links(docs, a, b), "alignment-links")
    counts, two = scratch(pair_counts(aligned), "alignment-counts")
    # at most one row per id of A's vocabulary
    best = counts.groupBy(F.shiftright("pair", SHIFT).alias("a")).agg(F.max("n_docs").alias("most"))
    judged = counts.join(F.broadcast(best), F.shiftright("pair", SHIFT) == F.col("a")).select("pair", (F.col("n_docs") * 2 + (F.col("n_docs") == F.col("most")).cast("long")).alias("value"))
    values = _unpacked(aligned, False).join(judged, "pair").select("slice", "pair", "value")
    out = ["n_a", "n_b", "n_groups", "n_links", "n_shared"]
    rows = aligned.select("slice", "doc_id", *out, "groups_sha256", "links").unionByName(values, allowMissingColumns=True)
    # a slice's values come before its documents
    rows = rows.repartition("slice").sortWithinPartitions("slice", F.col("pair").isNull())
    key = aligned.schema["doc_id"].dataType.simpleString()

    def run(batches):
        current, pairs, values, table = None, [], [], None
        for batch in batches:
            number = batch.column("slice").to_numpy()
            value = np.asarray(batch.column("pair").is_valid())
            cuts = np.flatnonzero(np.concatenate(([True], (number[1:] != number[:-1]) | (value[1:] != value[:-1]), [True])))
            for p, q in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                part = batch.slice(p, q - p)
                if number[p] != current:
                    current, pairs, values, table = number[p], [], [], None
                if value[p]:
                    pairs.append(part.column("pair").to_numpy())
                    values.append(part.column("value").to_numpy())
                    continue
                if table is None:
                    table = np.concatenate([*values, np.zeros(0, np.int64)])[np.argsort(np.concatenate([*pairs, np.zeros(0, np.int64)]))]
                kind = _narrow(len(table))
                got = [table[np.frombuffer(x, kind)] for x in part.column("links").to_pylist()]
                sums = [pa.array([int(f(x)) for x in got], pa.int64()) for f in (lambda x: (x & 1).sum(), lambda x: (x >> 1).sum())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", *out)), *sums, part.column("groups_sha256")], ["doc_id", *out, "n_best", "count_sum", "groups_sha256"])
        release(keep=True)

    done = settle(rows.mapInArrow(run, f"doc_id {key}, " + ", ".join(f"{c} long" for c in (*out, "n_best", "count_sum")) + ", groups_sha256 string"), "alignment")
    discard(spark, one, two)
    return done
