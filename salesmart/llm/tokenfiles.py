"""Raw token-id shards with a minimal perfect hash index.

A shard is three parts: ``.ids`` (the raw ids, 16 bits each where the
vocabulary allows, else 32), ``.idx`` (record offsets, the hash function's bit
levels, and per slot a 32-bit fingerprint with the key's first record and
number of records).  Looking up a key hashes it to one slot, compares the
fingerprint and reads the payload at the slot's offset: constant time, and
no keys are stored.

Shards hold ascending ranges of keys.  Each task writes its own shard under a
temporary name and renames it, so a repeated task leaves the same files.

NULL keys come first and are a key like any other; repeated keys are
consecutive records of one slot in each shard they
reach (ordered by a hash of the text and the text).  NULL text is empty: the
end id alone.  An empty table has no shard and reads as no row.
"""

from __future__ import annotations

import io
import uuid
import zlib
from array import array
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.config import shared_path
from salesmart.llm.common import mix, release, settle, slices, texts
from salesmart.llm.tokens import encoder, with_end

MAGIC = b"TOKSHRD1"
#: Bits of a level for each key that is left, and levels at most (keys beyond them are listed).
GAMMA, LEVELS = 2, 32
#: Ids that one read of the payload takes at most (a longer record is read alone).
SPAN = 1 << 20
#: Bytes of text that are encoded together.
ENCODED_BYTES = 1 << 20


def key_hashes(keys: list) -> np.ndarray:
    """A 64-bit hash of each key (integers, or anything with a distinct ``str``); None is a key."""
    out = np.empty(len(keys), np.uint64)
    for k, key in enumerate(keys):
        if isinstance(key, int):
            out[k] = key & 0xFFFFFFFFFFFFFFFF
        else:
            out[k] = int.from_bytes(blake2b(repr(key).encode(), digest_size=8).digest(), "little")
    return mix(out + np.uint64(0x632BE59BD9B4E019))


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype("<u4")


def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Levels of bits: a key's slot is the rank of the first bit that it alone set."""

    def __init__(self, levels: list[np.ndarray], listed: np.ndarray):
        self.levels, self.listed = levels, listed
        self.before, total = [], 0
        for bits in levels:
            ranks = np.cumsum(bits, dtype=np.int64)
            self.before.append(total + ranks - 1)
            total += int(ranks[-1]) if len(ranks) else 0
        self.counted = total

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        """``hashes`` must be distinct."""
        levels, left = [], hashes
        while len(left) and len(levels) < LEVELS:
            size = max(64, -(-GAMMA * len(left) // 64) * 64)
            at = _place(left, len(levels), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, bool)
            bits[at[alone]] = True
            levels.append(bits)
            left = left[~alone]
        return cls(levels, np.sort(left))

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for level, bits in enumerate(self.levels):
            at = _place(hashes[open_], level, len(bits))
            hit = bits[at]
            out[open_[hit]] = self.before[level][at[hit]]
            open_ = open_[~hit]
        if len(open_) and len(self.listed):
            at = np.minimum(np.searchsorted(self.listed, hashes[open_]), len(self.listed) - 1)
            hit = self.listed[at] == hashes[open_]
            out[open_[hit]] = self.counted + at[hit]
        return out


def dump_index(hashes: np.ndarray, first: np.ndarray, count: np.ndarray, offsets: np.ndarray, width: int) -> bytes:
    """The ``.idx`` file of a shard whose distinct keys have these hashes, first records and record counts."""
    function = PerfectHash.build(hashes)
    slot = function.slots(hashes)
    prints, firsts, counts = np.zeros(len(hashes), "<u4"), np.zeros(len(hashes), "<u8"), np.zeros(len(hashes), "<u4")
    prints[slot], firsts[slot], counts[slot] = fingerprints(hashes), first, count
    out = io.BytesIO()
    out.write(MAGIC)
    out.write(np.array([width, len(hashes), len(offsets) - 1, len(function.levels), len(function.listed), *map(len, function.levels)], "<u8").tobytes())
    for bits in function.levels:
        out.write(np.packbits(bits).tobytes())
    for part in (function.listed.astype("<u8"), prints, firsts, counts, offsets.astype("<u8")):
        out.write(part.tobytes())
    return out.getvalue()


class Index:
    """A read ``.idx`` file."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a token shard index")
        self.width, keys, records, levels, listed = (int(x) for x in np.frombuffer(raw, "<u8", 5, 8))
        sizes = np.frombuffer(raw, "<u8", levels, 48)
        at = 48 + 8 * levels

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(raw, kind, n, at)
            at += got.nbytes
            return got

        bits = [np.unpackbits(take("u1", int(size) // 8)).astype(bool) for size in sizes]
        self.function = PerfectHash(bits, take("<u8", listed))
        self.prints, self.first, self.count, self.offsets = take("<u4", keys), take("<u8", keys), take("<u4", keys), take("<u8", records + 1)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First record and number of records of each key; 0 records if its fingerprint is not there."""
        slot = self.function.slots(hashes)
        known = slot >= 0
        known[known] = self.prints[slot[known]] == fingerprints(hashes[known])
        first, count = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        first[known], count[known] = self.first[slot[known]], self.count[slot[known]]
        return first, count


def _files(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write(docs: DataFrame, uri: str, tokenizer: str, end_id: int = 2, width: int = 2) -> DataFrame:
    """Write the shards; one manifest row per shard, in key order.

    ``width``: bytes of an id (2 for vocabularies up to 65,536).  ``uri``: a
    folder that the driver and all executors reach (pyarrow file systems).
    """
    docs = texts(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        files, root = _files(uri)
        files.create_dir(root, recursive=True)
        context = TaskContext.get()
        name = f"shard-{context.partitionId():07d}"
        mine = f"{root}/.{name}-{context.taskAttemptId()}-{uuid.uuid4().hex}"
        encode = encoder(tokenizer)
        lengths, keys, repeats = array("q"), [], array("q")
        with files.open_output_stream(f"{mine}.ids") as payload:
            for part in slices(batches, max_bytes=ENCODED_BYTES):
                ids, counts = with_end(*encode.ids(part.column("text")), end_id)
                payload.write(ids.astype(f"<u{width}").tobytes())
                lengths.frombytes(counts.astype(np.int64).tobytes())
                for key in part.column("doc_id").to_pylist():
                    if keys and key == keys[-1]:
                        repeats[-1] += 1
                    else:
                        keys.append(key)
                        repeats.append(1)
        if not keys:
            files.delete_file(f"{mine}.ids")
            release(keep=True)
            return
        count = np.array(repeats, np.int64)
        offsets = np.concatenate(([0], np.cumsum(np.array(lengths, np.int64))))
        with files.open_output_stream(f"{mine}.idx") as index:
            index.write(dump_index(key_hashes(keys), np.cumsum(count) - count, count, offsets, width))
        for ending in ("ids", "idx"):
            files.move(f"{mine}.{ending}", f"{root}/{name}.{ending}")
        real = [k for k in keys if k is not None]
        key_type = part.column("doc_id").type
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([real[0] if real else None], key_type), pa.array([len(real) < len(keys)]), pa.array([len(lengths)], pa.int64()), pa.array([int(offsets[-1])], pa.int64())],
            ["shard", "first_key", "has_null", "records", "ids"],
        )
        release(keep=True)

    # one id may have any share of the rows: its rows are parted by their texts
    spread = F.xxhash64("text")
    ordered = docs.repartitionByRange("doc_id", spread).sortWithinPartitions("doc_id", spread, "text")
    manifest = settle(ordered.mapInArrow(run, f"shard string, first_key {kind}, has_null boolean, records long, ids long"), "tokenfiles-manifest")
    # one row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("ids_before", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def spans(start: np.ndarray, stop: np.ndarray) -> list[slice]:
    """Records that follow each other in the payload, up to about SPAN ids at once."""
    out, a = [], 0
    for k in range(1, len(start) + 1):
        if k == len(start) or start[k] != stop[k - 1] or stop[k] - start[a] > SPAN:
            out.append(slice(a, k))
            a = k
    return out


def read(keys: DataFrame, uri: str, manifest: DataFrame, tokens: bool = True) -> DataFrame:
    """Look up the distinct ``doc_id`` of ``keys``: one row per record, ``doc_id, start, n_tokens, ids_crc32`` and, if ``tokens``, the ``ids`` (32-bit).

    ``start`` counts the ids of all records before it.  Keys without a record
    give no row.  The manifest (one row per shard) is held by every task.
    """
    shards = [tuple(r) for r in manifest.select("shard", "first_key", "has_null", "ids_before").orderBy("shard").toLocalIterator()]
    kind = keys.schema["doc_id"].dataType.simpleString()
    if not shards:
        return keys.sparkSession.createDataFrame([], f"doc_id {kind}, start long, n_tokens long, ids_crc32 long" + ", ids binary" * tokens)
    known = [i for i, s in enumerate(shards) if s[1] is not None]
    firsts = [shards[i][1] for i in known]
    null_shards = [i for i, s in enumerate(shards) if s[2]]

    def route(batches):
        from bisect import bisect_left, bisect_right

        for batch in batches:
            column = batch.column("doc_id")
            rows, at = [], []
            for row, k in enumerate(column.to_pylist()):
                # an id may end one shard and fill those that begin with it
                some = null_shards if k is None else known[max(0, bisect_left(firsts, k) - 1) : max(1, bisect_right(firsts, k))]
                rows += [row] * len(some)
                at += some
            yield pa.RecordBatch.from_arrays([column.take(pa.array(rows, pa.int64())), pa.array(at, pa.int64())], ["doc_id", "shard"])

    def look(batches):
        files, root = _files(uri)
        opened, index, payload = None, None, None
        for batch in batches:
            at = batch.column("shard").to_numpy()
            for shard in np.unique(at):
                if shard != opened:
                    name = f"{root}/{shards[shard][0]}"
                    with files.open_input_stream(f"{name}.idx") as raw:
                        index = Index(raw.read())
                    payload, opened = files.open_input_file(f"{name}.ids"), shard
                some = batch.filter(pa.array(at == shard)).column("doc_id")
                first, count = index.find(key_hashes(some.to_pylist()))
                which = np.repeat(np.arange(len(first)), count)
                record = np.repeat(first - np.cumsum(count) + count, count) + np.arange(len(which))
                start, stop = index.offsets[record].astype(np.int64), index.offsets[record + 1].astype(np.int64)
                for rows in spans(start, stop):
                    lo, hi = int(start[rows][0]), int(stop[rows][-1])
                    coded = memoryview(np.frombuffer(payload.read_at((hi - lo) * index.width, lo * index.width), f"<u{index.width}").astype("<u4").tobytes())
                    parts = [coded[4 * (a - lo) : 4 * (b - lo)] for a, b in zip(start[rows].tolist(), stop[rows].tolist())]
                    out = [some.take(pa.array(which[rows])), pa.array(start[rows] + shards[shard][3]), pa.array((stop - start)[rows]), pa.array([zlib.crc32(x) for x in parts], pa.int64())]
                    yield pa.RecordBatch.from_arrays(out + [pa.array([bytes(x) for x in parts], pa.binary())] * tokens, ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * tokens)
        # reading needs no tokenizer: what the workers kept of the writing goes too
        opened = index = payload = None
        release()

    routed = keys.select("doc_id").distinct().mapInArrow(route, f"doc_id {kind}, shard long")
    # a number of partitions of its own: keys are small, the payload they stand for is not
    routed = routed.repartition(len(shards), "shard").sortWithinPartitions("shard", "doc_id")
    return routed.mapInArrow(look, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long" + ", ids binary" * tokens)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2, width: int = 2, tokens: bool = False) -> DataFrame:
    """Write all documents to a new folder in the shared space and read every one back by key."""
    uri = shared_path(docs.sparkSession, "llm", "tokenfiles")
    if "://" not in uri:
        uri = uri if uri.startswith("file:") else f"file://{uri}"
    manifest = write(docs, uri, tokenizer, end_id, width)
    return read(docs.select("doc_id"), uri, manifest, tokens)
