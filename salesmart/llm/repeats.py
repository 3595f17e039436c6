"""Repeated passages: super-k-mer partitioning of word windows.

A window is WINDOW consecutive words.  Its minimiser is the smallest hash of
the GRAM-word runs inside it, so equal windows have equal minimisers, and
consecutive windows mostly share one.  Such a run of windows travels as one
packed string (its words joined by blanks) to the bucket of its minimiser.
There, runs whose minimiser lies in one document only are dropped; the windows
of the others are sorted, and a window that also starts in a document with a
smaller id is repeated.

*Many buckets.*  The number of buckets follows the bytes of text, so what a
task holds does not grow with the input.  The strings of one slice and bucket
are compressed together.

*Hot groups.*  Of equal strings in a slice only those of the smallest id
travel: the others are repeated whatever happens elsewhere.  A first pass
finds runs of GRAM words that are very frequent (as the words of a shared
passage are); they rank behind all others as minimisers, so that the many
different windows across the edge of a shared passage go to the buckets of
their own rare words.  What is frequent is a share of the corpus, so a single
minimiser may still hold more than a task should: a bucket of more than
WHOLE_BYTES is read in parts of PART_BYTES.  Windows repeated within a part
are settled there; of every other window the part hands on its hash and the
places in the part's smallest document, and these meet by hash in a second
shuffle.

Ids are integers (others end in a cast error).  Documents of fewer than WINDOW words and NULL texts have no window.  A NULL id
is neither smaller nor larger than another: such documents keep all words.
Rows with the same id are one document (their windows do not repeat each
other); spans found in one of them are removed from all.  An empty table gives
no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import Words, by_slice, gram_hashes, inside, mix, release, settle, slices, split_by_ids, texts

#: Words of a window, and of the runs among which minimisers are chosen.
WINDOW, GRAM = 13, 3
#: Bytes of text whose strings share a bucket (the strings are about three times as long).
BUCKET_BYTES = 4 << 20
#: Bytes of text whose strings are packed together.
PACK_BYTES = 4 << 20
#: Bytes of a bucket (unpacked) that a task holds at once, and of the parts in which a larger one is read.
WHOLE_BYTES, PART_BYTES = 32 << 20, 8 << 20
#: Buckets dealt to one task at most, on average.
TASK_BUCKETS = 4
#: Cells of the frequency table; share of all runs from which a cell is frequent.
CELL_BITS, FREQUENT = 20, 2.0**-15


def frequent_cells(docs: DataFrame) -> np.ndarray:
    """Hash cells of very frequent runs of words; a list of at most 1 / FREQUENT cells."""
    size = 1 << CELL_BITS

    def run(batches):
        counts = np.zeros(size, np.int64)
        for part in slices(batches):
            words = Words(part.column("text"))
            grams = gram_hashes(words.hash, GRAM)[inside(words, GRAM)]
            counts += np.bincount((grams >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=size)
        total = int(counts.sum())
        some = np.flatnonzero(counts >= max(2, total * FREQUENT / 2))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(counts[some], total))], ["cell", "n"])

    sums = docs.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    rows = {r["cell"]: r["n"] for r in sums.where((F.col("cell") < 0) | (F.col("n") >= 16)).collect()}
    total = rows.pop(-1, 0)
    marks = np.zeros(size, bool)
    marks[[c for c, n in rows.items() if n >= total * FREQUENT]] = True
    return marks


def minimisers(words: Words, frequent: np.ndarray) -> np.ndarray:
    """The minimiser of the window that starts at each word (windows across rows included)."""
    grams = gram_hashes(words.hash, GRAM)
    behind = frequent[(grams >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
    # the order must not be that of the cells: mix again, and put frequent runs behind
    low = (mix(grams) >> np.uint64(1)) | (behind.astype(np.uint64) << np.uint64(63))
    have, want = 1, WINDOW - GRAM + 1
    while have < want:
        step = min(have, want - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return low


def _joined(words: Words) -> tuple[bytes, np.ndarray]:
    """All words of a slice joined by blanks, and where each one starts (one more entry at the end)."""
    length = words.end - words.start
    place = np.concatenate(([0], np.cumsum(length + 1)))
    out = np.full(place[-1], 32, np.uint8)
    within = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(place[:-1], length) + within] = words.data[np.repeat(words.start, length) + within]
    return out.tobytes(), place


def _pack(doc: np.ndarray, start: np.ndarray, third: np.ndarray, mini: np.ndarray, raw: bytes) -> bytes:
    import zstandard

    head = np.array([len(doc)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + mini.astype("<u8").tobytes() + doc.astype("<i8").tobytes() + start.astype("<i4").tobytes() + third.astype("<i4").tobytes() + raw)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    at, out = 8, []
    for kind in ("<u8", "<i8", "<i4", "<i4"):
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    return (*out, np.frombuffer(raw, np.uint8, offset=at))


def super_kmers(part: pa.RecordBatch, frequent: np.ndarray, buckets: int, own: int) -> pa.RecordBatch | None:
    """Rows ``bucket, settled, blob``: the packed strings of one slice by bucket, and in ``own`` the spans that are repeated for certain."""
    words = Words(part.column("text"))
    count = len(words.doc) - WINDOW + 1
    ids = part.column("doc_id")
    null = ids.is_null().to_numpy(zero_copy_only=False)
    ids = ids.fill_null(0).to_numpy()
    if count <= 0:
        return None
    fits = inside(words, WINDOW) & ~null[words.doc[:count]]
    low = minimisers(words, frequent)
    at = np.flatnonzero(fits)
    if not len(at):
        return None
    breaks = np.flatnonzero((np.diff(at) != 1) | (low[at[1:]] != low[at[:-1]]) | (words.doc[at[1:]] != words.doc[at[:-1]])) + 1
    first = at[np.concatenate(([0], breaks))]
    last = at[np.concatenate((breaks - 1, [len(at) - 1]))]
    raw, place = _joined(words)
    row = words.doc[first]
    mini, doc, start, size = low[first], ids[row], first - words.first[row], last - first + WINDOW
    strings = [raw[a:b] for a, b in zip(place[first].tolist(), (place[last + WINDOW] - 1).tolist())]
    travels = np.ones(len(strings), bool)
    held: dict[bytes, tuple[int, list[int]]] = {}
    for k, (string, d) in enumerate(zip(strings, doc.tolist())):
        known = held.get(string)
        if known is None or d < known[0]:
            if known is not None:
                travels[known[1]] = False
            held[string] = (d, [k])
        elif d == known[0]:
            known[1].append(k)
        else:
            travels[k] = False
    out_bucket, out_settled, blobs = [], [], []
    stays = np.flatnonzero(~travels)
    if len(stays):
        out_bucket, out_settled, blobs = [own], [True], [_pack(doc[stays], start[stays], start[stays] + size[stays], mini[stays], b"")]
    goes = np.flatnonzero(travels)
    bucket = (mix(mini) % np.uint64(buckets)).astype(np.int64)
    goes = goes[np.lexsort((mini[goes], bucket[goes]))]
    edges = np.flatnonzero(np.diff(bucket[goes])) + 1
    for group in np.split(goes, edges):
        if len(group):
            some = [strings[k] for k in group.tolist()]
            out_bucket.append(int(bucket[group[0]]))
            out_settled.append(False)
            blobs.append(_pack(doc[group], start[group], np.array([len(s) for s in some]), mini[group], b"".join(some)))
    return pa.RecordBatch.from_arrays([pa.array(out_bucket, pa.int64()), pa.array(out_settled, pa.bool_()), pa.array(blobs, pa.binary())], ["bucket", "settled", "blob"])


def repeated_windows(blobs: list[bytes], part: bool = False) -> tuple[np.ndarray, ...]:
    """Document, start and end (in words) of every stretch of repeated windows in one bucket, and two hashes.

    The hashes are None for repeated windows.  With ``part`` the blobs are a part of a bucket: windows that no smaller
    document of the part holds follow one by one, with their hashes.
    """
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), pa.nulls(0, pa.int64()), pa.nulls(0, pa.int64())
    kept: list[tuple] = []
    parts = [_unpack(b) for b in blobs]
    mini, doc = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    order = np.lexsort((doc, mini))
    new = np.concatenate(([True], mini[order][1:] != mini[order][:-1]))
    begin = np.flatnonzero(new)
    sorted_doc = doc[order]
    least, most = sorted_doc[begin], sorted_doc[np.concatenate((begin[1:], [len(order)])) - 1]
    shared = np.zeros(len(mini), bool)
    # a minimiser of one document in this part may be in others elsewhere
    shared[order] = part or np.repeat(least < most, np.diff(np.concatenate((begin, [len(order)]))))
    at = 0
    for _, p_doc, p_start, p_size, raw in parts:
        some = np.flatnonzero(shared[at : at + len(p_doc)])
        at += len(p_doc)
        if len(some):
            ends = np.cumsum(p_size.astype(np.int64))
            data = raw.tobytes()
            kept.append((p_doc[some], p_start[some], [data[a:b] for a, b in zip((ends - p_size)[some].tolist(), ends[some].tolist())]))
    if not kept:
        return nothing
    doc, start = (np.concatenate([k[j] for k in kept]).astype(np.int64) for j in (0, 1))
    strings = pa.array([s for k in kept for s in k[2]], pa.binary())
    words = Words(strings.cast(pa.string()))
    window = np.flatnonzero(inside(words, WINDOW))
    one, two = (gram_hashes(words.hash, WINDOW, seed)[window] for seed in (1, 2))
    row = words.doc[window]
    owner = doc[row]
    order = np.lexsort((owner, two, one))
    new = np.concatenate(([True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])))
    begin = np.flatnonzero(new)
    first_doc = np.repeat(owner[order][begin], np.diff(np.concatenate((begin, [len(order)]))))
    repeated = np.zeros(len(window), bool)
    repeated[order] = owner[order] > first_doc
    position = start[row] + window - words.first[row]
    at = np.flatnonzero(repeated)
    found = nothing
    if len(at):
        breaks = np.flatnonzero((np.diff(window[at]) != 1) | (np.diff(row[at]) != 0)) + 1
        head, tail = np.concatenate(([0], breaks)), np.concatenate((breaks - 1, [len(at) - 1]))
        none = pa.nulls(len(head), pa.int64())
        found = owner[at][head], position[at][head], position[at][tail] + WINDOW, none, none
    if not part:
        return found
    rest = np.flatnonzero(~repeated)
    late = [owner[rest], position[rest], position[rest] + WINDOW, one[rest].view(np.int64), two[rest].view(np.int64)]
    return tuple(pa.concat_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())]) for a, b in zip(found, late))


def _in_parts(blobs: list[bytes]) -> list[list[bytes]]:
    """The blobs in lists of about PART_BYTES unpacked (one blob at least)."""
    import zstandard

    out: list[list[bytes]] = []
    held = PART_BYTES
    for blob in blobs:
        if held >= PART_BYTES:
            out.append([])
            held = 0
        out[-1].append(blob)
        held += zstandard.frame_content_size(blob)
    return out


def _count(batches):
    """Rows ``doc_id, start, end, one, two`` of buckets sorted by number (see ``repeated_windows``)."""
    import zstandard

    names = ["doc_id", "start", "end", "one", "two"]
    as_batch = lambda columns: pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names)
    open_, blobs, held, hot = None, [], 0, False
    for batch in batches:
        for bucket, settled, blob in zip(*(batch.column(c) for c in ("bucket", "settled", "blob"))):
            bucket, settled, blob = bucket.as_py(), settled.as_py(), blob.as_py()
            if bucket != open_:
                for some in (_in_parts(blobs) if hot else [blobs] if blobs else []):
                    yield as_batch(repeated_windows(some, hot))
                open_, blobs, held, hot = bucket, [], 0, False
                release()
            if settled:
                _, doc, start, end, _ = _unpack(blob)
                none = pa.nulls(len(doc), pa.int64())
                yield as_batch((doc.astype(np.int64), start.astype(np.int64), end.astype(np.int64), none, none))
                continue
            blobs.append(blob)
            held += zstandard.frame_content_size(blob)
            if held >= (PART_BYTES if hot else WHOLE_BYTES):
                for some in _in_parts(blobs):
                    yield as_batch(repeated_windows(some, True))
                blobs, held, hot = [], 0, True
    for some in (_in_parts(blobs) if hot else [blobs] if blobs else []):
        yield as_batch(repeated_windows(some, hot))
    release()


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``: the stretches of words (start, end) covered by repeated windows, for documents that have any."""
    docs = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    size = docs.select(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    frequent = frequent_cells(docs)

    def pack(batches):
        own = TaskContext.get().partitionId() % buckets
        for part in slices(batches, max_bytes=PACK_BYTES):
            if (out := super_kmers(part, frequent, buckets, own)) is not None:
                yield out
        release()

    packed = docs.mapInArrow(pack, "bucket long, settled boolean, blob binary")
    # partitions follow the buckets, whatever the session's number of them
    parts = max(-(-buckets // TASK_BUCKETS), min(buckets, docs.sparkSession.sparkContext.defaultParallelism))
    dealt = packed.repartition(parts, "bucket")
    found = settle(dealt.sortWithinPartitions("bucket").mapInArrow(_count, "doc_id long, start long, end long, one long, two long"), "repeats-found")
    # windows of buckets read in parts: the smallest document of each, then the others
    late = found.where(F.col("one").isNotNull())
    first = late.groupBy("one", "two").agg(F.min("doc_id").alias("first_id"))
    again = late.join(first, ["one", "two"]).where(F.col("doc_id") > F.col("first_id"))
    spans = found.where(F.col("one").isNull()).select("doc_id", "start", "end").unionByName(again.select("doc_id", "start", "end"))
    return settle(spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "repeats-spans")


def strip(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: the words outside the document's spans, joined by one blank.

    Only documents that may have spans are moved to meet them.
    """
    key = docs.schema["doc_id"].dataType.simpleString()
    docs = texts(docs)
    schema = f"doc_id {key}, n_words long, n_removed long, kept string"

    def kept(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(part.column("text"))
        raw, place = _joined(words)
        spans_at = part.schema.get_field_index("spans")
        spans = part.column(spans_at).to_pylist() if spans_at >= 0 else [None] * part.num_rows
        removed, out = [], []
        for a, b, some in zip(words.first[:-1].tolist(), words.first[1:].tolist(), spans):
            if not some:
                removed.append(0)
                out.append(raw[place[a] : place[b] - 1] if b > a else b"")
                continue
            gone = np.zeros(b - a, bool)
            for span in some:
                gone[span["start"] : span["end"]] = True
            removed.append(int(gone.sum()))
            # the words between the gaps, stretch by stretch
            edges = np.flatnonzero(np.diff(np.concatenate(([True], gone, [True]))))
            out.append(b" ".join(raw[place[a + x] : place[a + y] - 1] for x, y in zip(edges[::2].tolist(), edges[1::2].tolist())))
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(np.diff(words.first).astype(np.int64)), pa.array(removed, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"]
        )

    clear, near = split_by_ids(docs, spans.select("doc_id"))
    near = near.join(spans.withColumn("doc_id", F.col("doc_id").cast(key)), "doc_id", "left").select("doc_id", "text", "spans")
    return by_slice(clear, kept, schema).unionByName(by_slice(near, kept, schema))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every document."""
    return strip(docs, repeated_spans(docs))
