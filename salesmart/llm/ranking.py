"""Ranked lexical search over a length-stratified index.

A document's score for an item sums, over the item's terms, the integer weight
of the term times ``(1000000000 * tf) div (1000 * tf + 20 * m)``, where ``m``
is the document's length normaliser.  Documents of equal ``m`` form a stratum.
In a stratum that impact depends on ``tf`` alone, so postings are kept in runs
of equal ``tf`` and every impact is computed once per run.

The index is a table with one row per block of a stratum: its documents, its
sorted terms, the number of documents and the highest ``tf`` of each term, and
the postings by term, falling ``tf`` and document.  A stratum with many tokens
(a third of all documents may be of one length) is dealt into blocks by a hash
of its rows, so no task gathers more than about ``BLOCK_TOKENS``.

A search takes its items in blocks of bounded size.  The highest ``tf`` of
each term bounds what a stratum can score.  The strata with the highest bounds
are visited first; the ``k``-th score found there is the item's threshold, and
the second wave leaves out every block whose bound is below it.  Bounds that
equal the threshold are visited, since ties go to the smaller id.

Terms are compared by 64-bit hashes.  NULL texts have no terms.  Documents
with a NULL id count and are ranked, last among equal scores; repeated rows
are documents of their own, and so are repeated items.  Items without terms,
or an empty table on either side, give no row.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm.common import Words, by_slice, discard, mix, release, scratch, settle, slices, texts

#: Bytes that part terms: all of ASCII but digits and letters.
PARTS = np.ones(256, bool)
PARTS[48:58] = PARTS[65:91] = PARTS[97:123] = PARTS[128:] = False
#: Tokens of a block of the index, bytes of items in one search, scores held at once, and strata visited first.
BLOCK_TOKENS, ITEM_BYTES, SCORES, FIRST = 1 << 18, 4 << 20, 1 << 22, 6
#: Blocks of tokens for each partition of the index.
PER_TASK = 8

INDEX = "m long, part int, docs array<long>, terms binary, df binary, top binary, runs binary, tfs binary, ends binary, postings binary"


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def normaliser(n: int, n_docs: int, n_terms: int) -> int:
    return 100 - 50 + (50 * n * n_docs) // n_terms


def _counts(part: pa.RecordBatch) -> np.ndarray:
    return np.diff(Words(part.column("text"), True, PARTS).first)


def lengths(docs: DataFrame) -> DataFrame:
    """``n, docs``: how many documents have ``n`` terms."""

    def run(batches):
        seen: dict[int, int] = defaultdict(int)
        for part in slices(batches):
            for n, c in zip(*(x.tolist() for x in np.unique(_counts(part), return_counts=True))):
                seen[n] += c
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["n", "docs"])
        release()

    return texts(docs).mapInArrow(run, "n long, docs long").where("n > 0").groupBy("n").agg(F.sum("docs").alias("docs"))


class Statistics:
    """Documents with a term, their terms, and the strata of more than one block."""

    def __init__(self, docs: DataFrame):
        held, path = scratch(lengths(docs), "ranking-lengths")
        self.n_docs, self.n_terms = (int(x or 0) for x in held.agg(F.sum("docs"), F.sum(F.col("n").cast("decimal(38,0)") * F.col("docs"))).first())
        self.parts: dict[int, int] = {}
        if self.n_docs:
            m = F.expr(f"50 + CAST((50 * CAST(n AS DECIMAL(18,0)) * {self.n_docs}BD) div {self.n_terms}BD AS BIGINT)")
            tokens = held.groupBy(m.alias("m")).agg(F.sum(F.col("n") * F.col("docs")).alias("tokens"))
            self.parts = {r["m"]: -(-r["tokens"] // BLOCK_TOKENS) for r in tokens.where(F.col("tokens") > BLOCK_TOKENS).toLocalIterator()}
        discard(docs.sparkSession, path)


def _forward(docs: DataFrame, stats: Statistics) -> DataFrame:
    """Rows of a slice's documents by stratum and part: ids, distinct terms per document, terms and counts."""
    n_docs, n_terms, parts = stats.n_docs, stats.n_terms, stats.parts

    def run(part: pa.RecordBatch) -> pa.RecordBatch | None:
        words = Words(part.column("text"), True, PARTS)
        if not len(words.doc):
            return None
        order = np.lexsort((words.hash, words.doc))
        doc, term = words.doc[order], words.hash[order]
        new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (term[1:] != term[:-1]))))
        tf = np.diff(np.append(new, len(doc))).astype(np.int32)
        doc, term = doc[new], term[new]
        n = np.diff(words.first)
        have, back = np.unique(n, return_inverse=True)
        m = np.array([normaliser(x, n_docs, n_terms) for x in have.tolist()], np.int64)[back]
        many = np.array([parts.get(x, 1) for x in m.tolist()], np.uint64)
        # a row's part follows from its words: no key decides it, whatever ids repeat
        begins = np.searchsorted(doc, np.arange(words.n + 1))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(term * tf.astype(np.uint64), dtype=np.uint64)))
        spot = mix(total[begins[1:]] - total[begins[:-1]] + np.arange(words.n, dtype=np.uint64))
        which = (spot % many).astype(np.int64)
        rows = np.flatnonzero(n)
        rows = rows[np.lexsort((rows, which[rows], m[rows]))]
        cut = np.flatnonzero(np.concatenate(([True], (m[rows][1:] != m[rows][:-1]) | (which[rows][1:] != which[rows][:-1]), [True])))
        ids = part.column("doc_id").take(pa.array(rows)).cast(pa.int64())
        out_m, out_part, out_n, out_term, out_tf = [], [], [], [], []
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            group = rows[a:b]
            spans = [slice(begins[r], begins[r + 1]) for r in group.tolist()]
            out_m.append(m[group[0]])
            out_part.append(which[group[0]])
            out_n.append(np.array([s.stop - s.start for s in spans], "<i4").tobytes())
            out_term.append(b"".join(term[s].tobytes() for s in spans))
            out_tf.append(b"".join(tf[s].tobytes() for s in spans))
        return pa.RecordBatch.from_arrays(
            [pa.array(out_m, pa.int64()), pa.array(out_part, pa.int32()), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), ids), *(pa.array(x, pa.binary()) for x in (out_n, out_term, out_tf))],
            ["m", "part", "docs", "n", "terms", "tf"],
        )

    return by_slice(texts(docs), run, "m long, part int, docs array<long>, n binary, terms binary, tf binary")


def _block(m: int, part: int, docs: list[pa.Array], n: list[bytes], terms: list[bytes], tf: list[bytes]) -> list:
    """One index row from the forward rows of a stratum's part."""
    n_terms = np.frombuffer(b"".join(n), "<i4")
    term, count = np.frombuffer(b"".join(terms), np.uint64), np.frombuffer(b"".join(tf), np.int32)
    doc = np.repeat(np.arange(len(n_terms), dtype=np.int32), n_terms)
    order = np.lexsort((doc, -count, term))
    term, count, doc = term[order], count[order], doc[order]
    fresh = np.concatenate(([True], term[1:] != term[:-1]))
    run = np.flatnonzero(fresh | np.concatenate(([True], count[1:] != count[:-1])))
    first = np.flatnonzero(fresh)
    return [
        m, part, pa.concat_arrays(docs), term[first].tobytes(), np.diff(np.append(first, len(term))).astype("<i4").tobytes(), count[first].astype("<i4").tobytes(),
        np.searchsorted(run, np.append(first, len(term))).astype("<i4").tobytes(), count[run].astype("<i4").tobytes(),
        np.append(run, len(term)).astype("<i4").tobytes(), doc.astype("<i4").tobytes(),
    ]


def build(docs: DataFrame, stats: Statistics) -> DataFrame:
    """The index of ``docs`` (columns INDEX)."""
    # as many partitions as the tokens ask for, whatever the session's number
    n = max(docs.sparkSession.sparkContext.defaultParallelism, -(-stats.n_terms // (PER_TASK * BLOCK_TOKENS)))
    dealt = _forward(docs, stats).repartition(n, "m", "part").sortWithinPartitions("m", "part")

    def rows(blocks: Iterator[list]):
        for block in blocks:
            m, part, ids, *raw = block
            yield pa.RecordBatch.from_arrays(
                [pa.array([m], pa.int64()), pa.array([part], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *(pa.array([x], pa.binary()) for x in raw)],
                ["m", "part", "docs", "terms", "df", "top", "runs", "tfs", "ends", "postings"],
            )

    def run(batches):
        def blocks():
            key, held = None, None
            for batch in batches:
                lists = batch.column("docs")
                for k, (m, part, n, terms, tf) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("m", "part", "n", "terms", "tf")))):
                    if (m, part) != key:
                        if held:
                            yield _block(*key, *held)
                        key, held = (m, part), ([], [], [], [])
                    for to, x in zip(held, (lists[k].values, n, terms, tf)):
                        to.append(x)
            if held:
                yield _block(*key, *held)

        yield from rows(blocks())
        release()

    return dealt.mapInArrow(run, INDEX)


class Items:
    """A bounded block of items: the terms of each, and the items of each term."""

    def __init__(self, table: pa.Table):
        words = Words(pa.concat_arrays(table.column("text").cast(pa.string()).chunks) if table.num_rows else pa.array([], pa.string()), True, PARTS)
        self.ids = table.column("item_id").to_pylist()
        pairs = np.unique(np.stack([words.hash, words.doc.astype(np.uint64)], 1), axis=0) if len(words.doc) else np.zeros((0, 2), np.uint64)
        self.terms, first = np.unique(pairs[:, 0], return_index=True)
        self.first = np.append(first, len(pairs))
        self.items = pairs[:, 1].astype(np.int64)
        self.weights = np.zeros(len(self.terms), np.int64)

    def __len__(self) -> int:
        return len(self.ids)

    def present(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the items' terms are among the sorted ``terms``, and where."""
        if not len(terms) or not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(terms, self.terms), len(terms) - 1)
        mine = np.flatnonzero(terms[at] == self.terms)
        return mine, at[mine]

    def bounds(self, m: int, mine: np.ndarray, top: np.ndarray) -> np.ndarray:
        """The most that a document with these highest counts can score, for every item."""
        most = self.weights[mine] * impact(top, m)
        many = self.first[mine + 1] - self.first[mine]
        at = np.repeat(self.first[mine] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
        out = np.zeros(len(self), np.int64)
        np.add.at(out, self.items[at], np.repeat(most, many))
        return out


def _document_counts(index: DataFrame, items: Items) -> np.ndarray:
    """How many documents hold each of the items' terms."""

    def run(batches):
        total = np.zeros(len(items.terms), np.int64)
        for batch in batches:
            for terms, df in zip(batch.column("terms").to_pylist(), batch.column("df").to_pylist()):
                mine, at = items.present(np.frombuffer(terms, np.uint64))
                total[mine] += np.frombuffer(df, "<i4")[at]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    got = index.select("terms", "df").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(len(items.terms), np.int64)
    out[got.column("term").to_numpy()] = got.column("df").to_numpy()
    return out


def _first_strata(index: DataFrame, items: Items) -> dict[int, list[int]]:
    """For each item the FIRST strata with the highest bounds: stratum -> items."""

    def run(batches):
        for batch in batches:
            for m, terms, top in zip(*(batch.column(c).to_pylist() for c in ("m", "terms", "top"))):
                mine, at = items.present(np.frombuffer(terms, np.uint64))
                most = items.bounds(m, mine, np.frombuffer(top, "<i4")[at])
                some = np.flatnonzero(most)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), m)), pa.array(some), pa.array(most[some])], ["m", "item", "most"])

    by_stratum = index.select("m", "terms", "top").mapInArrow(run, "m long, item long, most long").groupBy("item", "m").agg(F.max("most").alias("most"))
    # one row per item and distinct normaliser
    order = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("most"), "m"))
    out: dict[int, list[int]] = defaultdict(list)
    for r in by_stratum.withColumn("k", order).where(F.col("k") <= FIRST).collect():
        out[r["m"]].append(r["item"])
    return dict(out)


class Best:
    """The ``k`` best documents of each item so far, and the score that a further one must reach."""

    def __init__(self, k: int, floor: np.ndarray):
        self.k, self.floor, self.held = k, floor.copy(), {}

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        some = np.flatnonzero((scores > 0) & (scores >= self.floor[item]))
        if not len(some):
            return
        if len(some) > self.k:
            least = np.partition(scores[some], len(some) - self.k)[len(some) - self.k]
            some = some[scores[some] >= least]
        rows = (scores[some], ids[some], missing[some])
        if item in self.held:
            rows = tuple(np.concatenate(x) for x in zip(self.held[item], rows))
        keep = np.lexsort((rows[1], rows[2], -rows[0]))[: self.k]
        self.held[item] = tuple(x[keep] for x in rows)
        if len(keep) == self.k:
            self.floor[item] = max(self.floor[item], self.held[item][0][-1])


def _visit(index: DataFrame, items: Items, k: int, floor: np.ndarray, only: dict[int, list[int]] | None) -> DataFrame:
    """``item, doc_id, score`` of the best documents of each task; ``only`` names the items of a stratum."""

    def block(row: dict, best: Best) -> None:
        m, terms = row["m"], np.frombuffer(row["terms"], np.uint64)
        mine, at = items.present(terms)
        if not len(mine):
            return
        most = items.bounds(m, mine, np.frombuffer(row["top"], "<i4")[at])
        active = (most > 0) & (most >= best.floor)
        if only is not None:
            wanted = np.zeros(len(items), bool)
            wanted[only.get(m, [])] = True
            active &= wanted
        if not active.any():
            return
        runs, tfs, ends = (np.frombuffer(row[c], "<i4") for c in ("runs", "tfs", "ends"))
        postings = np.frombuffer(row["postings"], "<i4")
        ids = row["docs"]
        missing = np.asarray(ids.is_null())
        ids = ids.fill_null(0).to_numpy()
        chosen = np.flatnonzero(active)
        step = max(1, SCORES // len(ids))
        for a in range(0, len(chosen), step):
            some = chosen[a : a + step]
            place = np.full(len(items), -1)
            place[some] = np.arange(len(some))
            scores = np.zeros((len(some), len(ids)), np.int64)
            for q, t in zip(mine.tolist(), at.tolist()):
                holders = place[items.items[items.first[q] : items.first[q + 1]]]
                holders = holders[holders >= 0]
                if not len(holders):
                    continue
                r = slice(runs[t], runs[t + 1])
                worth = np.repeat(items.weights[q] * impact(tfs[r], m), np.diff(ends[runs[t] : runs[t + 1] + 1]))
                scores[holders[:, None], postings[ends[runs[t]] : ends[runs[t + 1]]][None, :]] += worth
            for j, item in enumerate(some.tolist()):
                best.add(item, scores[j], ids, missing)

    def run(batches):
        best = Best(k, floor)
        for batch in batches:
            lists = batch.column("docs")
            for j, row in enumerate(batch.drop_columns(["docs"]).to_pylist()):
                block({**row, "docs": lists[j].values}, best)
        for item, (scores, ids, missing) in best.held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), item)), pa.array(ids, mask=missing), pa.array(scores)], ["item", "doc_id", "score"])
        release()

    return index.mapInArrow(run, "item long, doc_id long, score long")


def _merge(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each item with their rank: first in 64 heaps by document, then all."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    heap = F.pmod(F.xxhash64("doc_id"), F.lit(64))
    part = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", heap).orderBy(*order))).where(F.col("rank") <= k)
    return part.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def _search(spark: SparkSession, index: DataFrame, items: Items, stats: Statistics, k: int) -> DataFrame:
    df = _document_counts(index, items)
    items.weights = np.array([weight(stats.n_docs, x) for x in df.tolist()], np.int64)
    first = _first_strata(index, items)
    floor = np.zeros(len(items), np.int64)
    begun = index.where(F.col("m").isin(list(first)))
    for r in _merge(_visit(begun, items, k, floor, first), k).where(F.col("rank") == k).select("item", "score").collect():
        floor[r["item"]] = r["score"]
    ids = spark.createDataFrame(list(enumerate(items.ids)), "item long, item_id long")
    ranked = _merge(_visit(index, items, k, floor, None), k)
    return ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, benchmark: DataFrame, k: int = 50) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item."""
    spark = docs.sparkSession
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    stats = Statistics(docs)
    if not stats.n_docs:
        return empty
    index, folder = scratch(build(docs, stats), "ranking-index")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.length("text") > 0)
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = -(-size // ITEM_BYTES)
    spot = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks or 1))
    out = empty
    for b in range(blocks):
        block = Items(items.where(spot == b).toArrow())
        if len(block.terms):
            out = out.unionByName(settle(_search(spark, index, block, stats, k), "ranking"))
    discard(spark, folder)
    return out


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH t AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY ALL),
s AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM d),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
 FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
r AS (SELECT q.item_id, p.doc_id, CAST(sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * (50 + (50 * d.n * s.n_docs) // s.n_terms)))) AS BIGINT) AS score
 FROM q JOIN p ON p.term = q.term JOIN w ON w.term = q.term JOIN d ON d.doc_id = p.doc_id, s GROUP BY q.item_id, p.doc_id)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
 SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0) x WHERE rank <= 50
"""
