"""Harmonic packing of documents into fixed-length token sequences.

A piece of ``capacity // j`` ids belongs to reciprocal class ``j``; a sequence
of that class holds exactly ``j`` pieces, so it is filled by counting, without
looking at other classes or other workers.  Documents may be cut: each one is
cut into full sequences and a rest, and the rest into pieces whose lengths are
exactly those of a class, by a table that weighs the number of pieces against
the padding.  Each worker numbers its own pieces per class; the workers'
counts (one small row per worker and class) turn these into places in the
class.  Only the last, incomplete sequence of each class is left: these
pieces, bounded by the capacity alone, share sequences first-fit.

Nulls and empty texts are documents of one id (the end id).  Repeated rows are
packed once each.  An empty table gives no row.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import release, settle, slices, texts
from salesmart.llm.tokens import CACHED, encoder, with_end

#: What one more piece may cost, in ids of padding.
PIECE_COST = 12


def class_sizes(capacity: int) -> list[int]:
    """Lengths of the reciprocal classes, largest first."""
    return sorted({capacity // j for j in range(1, capacity + 1)}, reverse=True)


def cut_table(capacity: int) -> list[tuple[int, ...]]:
    """For each rest below ``capacity``, its cheapest cut into class lengths (longest first)."""
    sizes = np.array(class_sizes(capacity))
    per_piece = PIECE_COST + (capacity % sizes) / (capacity // sizes)
    best = np.full(capacity, np.inf)
    best[0] = 0
    last = np.zeros(capacity, int)
    for rest in range(1, capacity):
        fits = sizes <= rest
        cost = per_piece[fits] + best[rest - sizes[fits]]
        at = int(cost.argmin())
        best[rest], last[rest] = cost[at], sizes[fits][at]
    cuts: list[tuple[int, ...]] = [()]
    for rest in range(1, capacity):
        cuts.append(tuple(sorted((last[rest].item(), *cuts[rest - last[rest]]), reverse=True)))
    return cuts


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, cached: int = CACHED, width: int = 2, slice_bytes: int = 4 << 20) -> DataFrame:
    """Documents cut into pieces: ``ids`` (little-endian, ``width`` bytes each), their ``ids_crc32`` as 32-bit ids, class length ``length``, and the piece's number within its worker and class."""
    cuts = cut_table(capacity)

    def run(batches):
        encode, worker = encoder(tokenizer, cached), TaskContext.get().partitionId()
        numbered: dict[int, int] = {}

        def cut(part: pa.RecordBatch) -> pa.RecordBatch:
            rows, start, length, number, total = [], [], [], [], []
            all_ids, counts = with_end(*encode.ids(part.column("text")), end_id)
            for row, n in enumerate(counts.tolist()):
                at = 0
                for size in (*(capacity,) * (n // capacity), *cuts[n % capacity]):
                    seen = numbered.get(size, 0)
                    numbered[size] = seen + 1
                    rows.append(row)
                    start.append(at)
                    length.append(size)
                    number.append(seen)
                    total.append(n)
                    at += size
            key = part.column("doc_id").take(pa.array(rows, pa.int64()))
            longs = [pa.array(x, pa.int64()) for x in (start, length, total, number)]
            workers = pa.array(np.full(len(rows), worker), pa.int64())
            # the pieces follow each other as the ids do
            ends = np.concatenate(([0], np.cumsum(length))).astype(np.int64)
            wide = memoryview(all_ids.astype("<u4").tobytes())
            crc = pa.array([zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.int64())
            raw = pa.py_buffer(all_ids.astype(f"<u{width}").tobytes())
            ids = pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer((width * ends).tobytes()), raw]).cast(pa.binary())
            return pa.RecordBatch.from_arrays([key, longs[0], longs[1], longs[2], workers, longs[3], crc, ids], ["doc_id", "start", "length", "doc_tokens", "worker", "number", "ids_crc32", "ids"])

        for part in slices(batches, max_bytes=slice_bytes):
            yield cut(part)
        release(keep=True)

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {key}, start long, length long, doc_tokens long, worker long, number long, ids_crc32 long, ids binary")


def leftovers(totals: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """First-fit of each class's incomplete last sequence: (length, number, sequence, offset); sequences used."""
    room: list[int] = []
    places = []
    for size in sorted(totals, reverse=True):
        count, full = totals[size] % (capacity // size), totals[size] - totals[size] % (capacity // size)
        seq = 0
        for k in range(count):
            while seq < len(room) and room[seq] < size:
                seq += 1
            if seq == len(room):
                room.append(capacity)
            places.append((size, full + k, seq, capacity - room[seq]))
            room[seq] -= size
    return places, len(room)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, cached: int = CACHED, width: int = 2, slice_bytes: int = 4 << 20) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, ids_crc32, ids, sequence_id, offset``.

    ``cached``: chunks of text whose ids each worker remembers (about 60 bytes
    each).  ``slice_bytes``: text that is encoded at once (about 60 times as
    much memory).  ``width``: bytes of an id in ``ids`` (2 for vocabularies up to
    65,536); ``ids_crc32`` is of the ids as 32-bit integers.
    """
    spark = docs.sparkSession
    cut = settle(pieces(texts(docs), tokenizer, capacity, end_id, cached, width, slice_bytes), "packing")
    counts = cut.groupBy("length", "worker").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "worker", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"), "n")
    counts = settle(counts, "packing-counts")
    # one row per class: their number is bounded by the capacity
    totals = {r["length"]: r["total"] for r in counts.groupBy("length").agg(F.sum("n").alias("total")).collect()}
    shared, used = leftovers(totals, capacity)
    classes, base = [], used
    for size in sorted(totals, reverse=True):
        per = capacity // size
        classes.append((size, per, base, totals[size] - totals[size] % per))
        base += totals[size] // per
    by_class = F.broadcast(spark.createDataFrame(classes, "length long, per long, base long, full long"))
    rest = F.broadcast(spark.createDataFrame(shared, "length long, place long, seq long, shift long"))
    placed = (
        cut.join(counts.drop("n"), ["length", "worker"])
        .withColumn("place", F.col("ahead") + F.col("number"))
        .join(by_class, "length")
        .join(rest, ["length", "place"], "left")
    )
    return placed.select(
        "doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids",
        F.coalesce("seq", F.col("base") + F.expr("place div per")).alias("sequence_id"),
        F.coalesce("shift", F.col("place") % F.col("per") * F.col("length")).alias("offset"),
    )
