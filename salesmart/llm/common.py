"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import re
import sys
import types
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesmart.config import shared_path
from salesmart.sinks.publish import remove_path

#: A word: a run of characters other than the six ASCII white-space characters.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: The same, for Spark's and DuckDB's regular expressions.
NOT_WORD_SQL = r"[\x20\x09-\x0D]+"
#: Lower-cases A-Z only.
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}

#: Texts are handled in slices of about this many bytes, whatever the Arrow batch size.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id`` and ``text`` alone (NULL text stays NULL); other columns cannot clash."""
    return df.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


_open: list[list[str]] = []


def settle(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a place every executor reaches, so a lost executor
    costs a reread and not a recomputation.  Inside ``temporary`` the table
    lives as long as that block, unless ``keep``.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", name)
    df.write.parquet(path)
    if _open and not keep:
        _open[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables settled inside are removed at the end; results must be settled with ``keep``."""
    paths: list[str] = []
    _open.append(paths)
    try:
        yield
    finally:
        _open.pop()
        discard(spark, *paths)


def scratch(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``settle``, with the folder, for a table that ``discard`` removes when it has been used."""
    spark = df.sparkSession
    path = shared_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove scratch folders whose readers have run."""
    for path in paths:
        remove_path(spark, path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows here are whole texts: hand them to Python a thousand at a time.

    An executor that runs many steps keeps the buffers of the largest batch,
    in the JVM and in its Python workers.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of at most ``max_bytes`` of ``column`` (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(size.astype(np.int64) + 16)
        at = 0
        while at < n:
            base = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, base + max_bytes, "right")))
            yield batch.slice(at, end - at)
            at = end


def worker_store() -> dict:
    """What this Python worker keeps between tasks.

    Functions are pickled by value, so module variables begin anew in every
    task; this dictionary hangs on the worker's interpreter.
    """
    return sys.modules.setdefault("_salesmart_worker", types.ModuleType("_salesmart_worker")).__dict__.setdefault("store", {})


def release(keep: bool = False) -> None:
    """Give freed memory back to the system: a reused Python worker otherwise keeps its largest task's.

    What the worker stored goes too unless ``keep``: another operator has begun.
    """
    if not keep:
        worker_store().clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        return


def by_slice(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch] | pa.RecordBatch | None], schema: StructType | str, column: str = "text", keep: bool = False) -> DataFrame:
    """``mapInArrow`` that hands ``fn`` one bounded slice of texts at a time."""

    def run(batches):
        for part in slices(batches, column):
            out = fn(part)
            if out is None:
                continue
            if isinstance(out, pa.RecordBatch):
                out = (out,)
            yield from out
        release(keep)

    return df.mapInArrow(run, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (every input bit reaches every output bit)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Byte classes: True for the six white-space bytes that part words.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(63, _MULTIPLIER))))


class Words:
    """The words of a slice of texts, as arrays.

    ``data``: the slice's UTF-8 bytes; ``start`` / ``end``: byte range of each
    word; ``doc``: row of each word; ``first``: index of each row's first word
    (one more entry at the end); ``hash``: a 64-bit hash of each word.
    ``parts`` tells the bytes that part words.
    """

    def __init__(self, column: pa.Array, lower: bool = False, parts: np.ndarray = _SPACE):
        column = column.cast(pa.large_string())
        n = len(column)
        if column.null_count:
            column = pc.fill_null(column, "")
        bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw is not None else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        if lower:
            data = _LOWER[data]
        # a virtual blank after each row parts the words of neighbouring rows
        blank = parts[data]
        word = ~blank
        begins = word.copy()
        begins[1:] &= blank[:-1]
        edges = bounds[1:-1]
        edges = edges[edges < len(data)]
        begins[edges] |= word[edges]
        start = np.flatnonzero(begins)
        stops = word.copy()
        stops[:-1] &= blank[1:] | begins[1:]
        end = np.flatnonzero(stops) + 1
        self.data, self.start, self.end, self.n = data, start, end, n
        self.first = np.searchsorted(start, bounds, "left")
        self.doc = np.repeat(np.arange(n), np.diff(self.first))
        self.bounds = bounds

    _hash = None

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = word_hashes(self.data, self.start, self.end)
        return self._hash


def _sums(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The polynomial of each byte range; ranges in any order and of any length."""
    length = end - start
    total = np.concatenate(([0], np.cumsum(length)))
    place = np.arange(total[-1], dtype=np.int32) - np.repeat(total[:-1].astype(np.int32), length)
    values = data[place + np.repeat(start.astype(np.int32), length)].astype(np.uint64) + np.uint64(1)
    # words over 64 bytes: each 64-byte turn uses another odd multiplier
    values *= _POWERS[place & 63]
    if length.max() > 64:
        values *= (place >> 6).astype(np.uint64) * np.uint64(0xD1342543DE82EF94) + np.uint64(1)
    return np.add.reduceat(values, total[:-1])


#: Bytes whose words are hashed together; their powers stay in the processor's cache.
_BLOCK = 1 << 15


def _sums_in_order(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The same for ranges in ascending order: every byte counts by its place in a block, and a range's sum is divided by its start's power."""
    out = np.empty(len(start), np.uint64)
    powers, inverses = (np.multiply.accumulate(np.append(np.uint64(1), np.full(_BLOCK + 63, m, np.uint64))) for m in (_MULTIPLIER, _INVERSE))
    stop = np.minimum(end, start + 64)
    edges = np.searchsorted(start, np.arange(int(start[0]), int(start[-1]) + _BLOCK + 1, _BLOCK)).tolist()
    for a, b in zip(edges[:-1], edges[1:]):
        if a == b:
            continue
        base = int(start[a])
        n = int(stop[a:b].max()) - base
        values = np.zeros(n + 1, np.uint64)
        values[:n] = data[base : base + n]
        values[:n] += np.uint64(1)
        values[:n] *= powers[:n]
        at = np.empty(2 * (b - a), np.int64)
        at[::2], at[1::2] = start[a:b], stop[a:b]
        at -= base
        out[a:b] = np.add.reduceat(values, at)[::2] * inverses[at[::2]]
    long = np.flatnonzero(end - start > 64)
    if len(long):
        out[long] = _sums(data, start[long], end[long])
    return out


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each byte range, mixed with its length."""
    if not len(start):
        return np.zeros(0, np.uint64)
    sums = (_sums if (start[1:] < start[:-1]).any() else _sums_in_order)(data, start, end)
    return mix(sums ^ ((end - start).astype(np.uint64) << np.uint64(48)))


def gram_hashes(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``n`` neighbouring hashes (runs across rows included)."""
    count = len(h) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(count, seed + 0x51ED27, np.uint64)
    for k in range(n):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[k : k + count]
    return mix(out)


def inside(words: Words, n: int) -> np.ndarray:
    """Which runs of ``n`` neighbouring words lie in one row."""
    count = len(words.doc) - n + 1
    if count <= 0:
        return np.zeros(0, bool)
    return words.doc[:count] == words.doc[n - 1 :]


#: Positions of the filter of ids: a task holds this many bits whatever the number of ids.
FILTER_BITS = 23


def _positions(ids: pa.Array) -> np.ndarray:
    ids = pc.fill_null(ids.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
    return (mix(ids.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def id_filter(ids: DataFrame) -> Callable[[pa.Array], np.ndarray]:
    """A test whether an integer id may be among ``ids`` (one column), of fixed size.

    It keeps rows that cannot meet ``ids`` out of a shuffle; the join behind
    it stays exact, and with very many ids it merely lets more rows pass.
    """
    name = ids.columns[0]

    def run(batches):
        marks = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            marks[_positions(batch.column(0))] = True
        words = np.packbits(marks).view("<i8")
        some = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(words[some])], ["word", "bits"])

    parts = ids.select(F.col(name).cast("long")).mapInArrow(run, "word long, bits long")
    got = parts.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros((1 << FILTER_BITS) // 64, "<i8")
    words[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    packed = words.view(np.uint8)

    def member(column: pa.Array) -> np.ndarray:
        at = _positions(column)
        return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)

    return member


def split_by_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` whose integer id is not among ``ids`` for certain, and the rows that may be; all columns unchanged."""
    member = id_filter(ids)

    def some(wanted: bool):
        def run(batches):
            for batch in batches:
                yield batch.filter(pa.array(member(batch.column(batch.schema.get_field_index(key))) == wanted))

        return docs.mapInArrow(run, docs.schema)

    return some(False), some(True)
