"""Benchmark decontamination: rare two-word seeds, then Smith-Waterman alignment.

A passage counts if its alignment scores SHARE of the item's best.  With m
matched words and e edits it scores 2m - e, so of an item of s words with
SHARE one half at most m - s/2 of the m - 1 neighbouring matched pairs have
two edits or more between them, and at least s/2 - 1 have one or none.  Such a
pair stands at (i, i+1) or (i, i+2) in the item, and next to each other or one
word apart in the document: these are the item's 2s - 3 seeds, and any choice
of all but ceil(s/2 - 1) - 1 of them has a matched one.  One pass over the
documents counts the documents that hold each seed, and the rarest are chosen.
A second pass finds the stretch around each seed that an alignment through it
could cover, passes over those that do not hold enough of the item's words,
and aligns the others with the item, word by word (Smith-Waterman with linear
gaps).  The result is that of aligning every document with every item.

The items are the stated query set: they are taken in blocks of at most
``BLOCK_WORDS`` words, so that what a task holds is bounded whatever their
number.  No document is moved, so a passage that a third of all documents
share is aligned where it lies.

Words are compared with A-Z in lower case.  Items of fewer than LEAST_WORDS words
count only where they stand word for word (a seed is their rarest pair, or
their only word); items without words match nothing, nor do NULL and empty texts.
Equal items each get their links; repeated documents get the same links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, StructField, StructType

from salesmart.llm.common import Words, by_slice, mix, settle, slices, split_by_ids, texts

#: Words of the shortest item that is aligned; share of the best possible alignment score from which a passage counts.
LEAST_WORDS, SHARE = 5, 0.5
#: Scores of an equal word, a changed word, and a word in only one of the two.
EQUAL, CHANGED, GAP = 2, -1, -1
#: Words of items in one block; cells of one batch of alignments.
BLOCK_WORDS, BATCH_CELLS = 1_000_000, 1 << 20
#: Places of items, or item words in their stretches, that are held together.
BATCH_HITS = 1 << 20
_TABLE_BITS = 20


@dataclass
class Block:
    """Some items: their ids, word hashes, and distinct words (sorted) with the places they come from."""

    ids: list
    words: list[np.ndarray]
    seeds: np.ndarray
    first: np.ndarray  # places of seed k: first[k]:first[k + 1]
    item: np.ndarray
    place: np.ndarray

    def keep(self, wanted: np.ndarray) -> Block:
        """Only the places that ``wanted`` marks."""
        owner = np.repeat(np.arange(len(self.seeds)), np.diff(self.first))
        count = np.bincount(owner[wanted], minlength=len(self.seeds))
        left = count > 0
        return Block(self.ids, self.words, self.seeds[left], np.concatenate(([0], np.cumsum(count[left]))), self.item[wanted], self.place[wanted])

    def table(self) -> np.ndarray:
        marks = np.zeros(1 << _TABLE_BITS, bool)
        marks[self.seeds & np.uint64((1 << _TABLE_BITS) - 1)] = True
        return marks


def pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One hash for each two words in order."""
    return mix(mix(first) + second)


def make_block(ids: list, words: list[np.ndarray], seeds: list[np.ndarray], places: list[np.ndarray]) -> Block:
    """Items with their ``seeds`` and the place of each seed's first word."""
    seed, place = np.concatenate(seeds), np.concatenate(places)
    item = np.repeat(np.arange(len(words)), [len(x) for x in seeds])
    order = np.argsort(seed, kind="stable")
    found, first = np.unique(seed[order], return_index=True)
    return Block(ids, words, found, np.concatenate((first, [len(seed)])).astype(np.int64), item[order], place[order])


def word_block(ids: list, words: list[np.ndarray]) -> Block:
    """Items by their single words."""
    return make_block(ids, words, words, [np.arange(len(w)) for w in words])


def item_seeds(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An item's seeds and their places: pairs of neighbours, and those with one word between if it is aligned; a lone word with itself."""
    if len(w) == 1:
        return pairs(w, w), np.zeros(1, np.int64)
    near = pairs(w[:-1], w[1:])
    if len(w) < LEAST_WORDS:
        return near, np.arange(len(near))
    far = pairs(w[:-2], w[2:])
    return np.concatenate((near, far)), np.concatenate((np.arange(len(near)), np.arange(len(far))))


def pair_block(ids: list, words: list[np.ndarray]) -> Block:
    """Items by their seeds."""
    both = [item_seeds(w) for w in words]
    return make_block(ids, words, [seeds for seeds, _ in both], [places for _, places in both])


def least_share(size: np.ndarray) -> np.ndarray:
    """Of items of ``size`` words, the share of the best score that counts."""
    return np.where(size < LEAST_WORDS, 1.0, SHARE)


def blocks(items: DataFrame) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Ids and words of the items in bounded blocks, in a stable order."""
    ids, words, held = [], [], 0
    for row in texts(items, key="item_id").orderBy("doc_id", "text").toLocalIterator():
        h = Words(pa.array([row["text"]], pa.string()), lower=True).hash
        if not len(h):
            continue
        ids.append(row["doc_id"])
        words.append(h)
        held += len(h)
        if held >= BLOCK_WORDS:
            yield ids, words
            ids, words, held = [], [], 0
    if ids:
        yield ids, words


def hits(hashes: np.ndarray, block: Block, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the hashes that are seeds, and which seed."""
    at = np.flatnonzero(table[hashes & np.uint64((1 << _TABLE_BITS) - 1)])
    seed = np.searchsorted(block.seeds, hashes[at])
    seed[seed == len(block.seeds)] = 0
    same = block.seeds[seed] == hashes[at]
    return at[same], seed[same]


def pair_hits(words: Words, block: Block, table: np.ndarray, lone: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the first words of seeds, next to each other or one word apart (``lone``: of single words too), and which seed."""
    found = []
    for apart in (0, 1, 2) if lone else (1, 2):
        end = len(words.hash) - apart
        if end <= 0:
            continue
        at, seed = hits(pairs(words.hash[:end], words.hash[apart:]), block, table)
        one = words.doc[at] == words.doc[at + apart]
        found.append((at[one], seed[one]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([at for at, _ in found]), np.concatenate([seed for _, seed in found])


def rarest(docs: DataFrame, block: Block) -> Block:
    """The block with each item's rarest seeds: all but one fewer than a passage that counts must match."""
    table, lone = block.table(), any(len(w) == 1 for w in block.words)

    def count(batches):
        sums = np.zeros(len(block.seeds), np.int64)
        for part in slices(batches):
            words = Words(part.column("text"), lower=True)
            at, seed = pair_hits(words, block, table, lone)
            held_by = np.unique(words.doc[at] * np.int64(len(block.seeds)) + seed) if len(at) else np.zeros(0, np.int64)
            sums += np.bincount(held_by % max(len(block.seeds), 1), minlength=len(block.seeds))
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], ["seed", "n"])

    # one row per seed of the block
    rows = docs.mapInArrow(count, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).toArrow()
    held = np.zeros(len(block.seeds), np.int64)
    held[rows.column("seed").to_numpy()] = rows.column("n").to_numpy()
    owner = np.repeat(np.arange(len(block.seeds)), np.diff(block.first))
    order = np.lexsort((block.place, held[owner], block.item))
    item = block.item[order]
    size = np.bincount(item, minlength=len(block.ids))
    rank = np.arange(len(item)) - np.repeat(np.cumsum(size) - size, size)
    wanted = np.zeros(len(item), bool)
    # order puts equal counts in the order of their place, so ties are the same in every run
    length = np.array([len(w) for w in block.words])
    # a short item must match all its seeds
    must = np.where(length < LEAST_WORDS, size, np.ceil(SHARE * length - 1))
    wanted[order] = rank <= size[item] - must[item]
    return block.keep(wanted)


class Overlap:
    """Tells which stretches of a slice hold as many of an item's words as a passage with SHARE of the score must match."""

    def __init__(self, block: Block):
        self.block, self.items = block, len(block.ids)
        owner = np.repeat(np.arange(len(block.seeds)), np.diff(block.first))
        size = np.array([len(w) for w in block.words])
        self.need = np.ceil(least_share(size) * size)
        # each word of each item, and how often it stands there
        self.pairs, self.times = np.unique(owner * np.int64(self.items) + block.item, return_counts=True)

    def enough(self, at: np.ndarray, seed: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which stretches ``low:high``, given the positions ``at`` of the block's words."""
        begin, many = np.searchsorted(at, low), np.searchsorted(at, high)
        many -= begin
        good = many >= self.need[item]
        some = np.flatnonzero(good)
        ends = np.cumsum(many[some])
        done = 0
        while done < len(some):
            base = ends[done - 1] if done else 0
            stop = max(done + 1, int(np.searchsorted(ends, base + BATCH_HITS, "right")))
            part, n = some[done:stop], many[some[done:stop]]
            owner = np.repeat(np.arange(len(part)), n)
            hit = np.repeat(begin[part] - np.cumsum(n) + n, n) + np.arange(n.sum())
            key = seed[hit] * np.int64(self.items) + item[part][owner]
            which = np.searchsorted(self.pairs, key)
            which[which == len(self.pairs)] = 0
            own = self.pairs[which] == key
            both, times = np.unique(owner[own] * np.int64(len(self.pairs)) + which[own], return_counts=True)
            matched = np.bincount(both // len(self.pairs), np.minimum(times, self.times[both % len(self.pairs)]), len(part))
            good[part] = matched >= self.need[item[part]]
            done = stop
        return good


def align(passages: list[np.ndarray], items: list[np.ndarray]) -> np.ndarray:
    """Best local alignment score of each passage with its item."""
    best = np.zeros(len(items), np.int64)
    order = sorted(range(len(items)), key=lambda k: (len(passages[k]), len(items[k])))
    at = 0
    while at < len(order):
        width, end = 0, at
        while end < len(order) and (end == at or (end - at + 1) * len(passages[order[end]]) <= BATCH_CELLS):
            width = max(width, len(passages[order[end]]))
            end += 1
        group = order[at:end]
        at = end
        tall = max(len(items[k]) for k in group)
        # padding matches nothing: passages and items are padded with different marks
        passage = np.full((len(group), width), -1, np.int64)
        item = np.full((len(group), tall), -2, np.int64)
        for row, k in enumerate(group):
            _, codes = np.unique(np.concatenate((passages[k], items[k])), return_inverse=True)
            passage[row, : len(passages[k])] = codes[: len(passages[k])]
            item[row, : len(items[k])] = codes[len(passages[k]) :]
        passage, item = passage.astype(np.int32), item.astype(np.int32)
        slope = np.arange(width, dtype=np.int32) * -GAP
        above = np.zeros((len(group), width), np.int32)
        top = np.zeros(len(group), np.int32)
        for k in range(tall):
            now = np.where(passage == item[:, k, None], np.int32(EQUAL), np.int32(CHANGED))
            now[:, 1:] += above[:, :-1]
            np.maximum(now, above + np.int32(GAP), out=now)
            np.maximum(now, 0, out=now)
            # a gap along the passage costs its length: a running maximum of value + slope
            now += slope
            np.maximum.accumulate(now, axis=1, out=now)
            now -= slope
            np.maximum(top, now.max(axis=1), out=top)
            above = now
        best[group] = top
    return best


def text_mark(text: str | None) -> bytes:
    """128 bits of a text."""
    return blake2b((text or "").encode("utf-8", "surrogatepass"), digest_size=16).digest()


def links(docs: DataFrame, items: DataFrame, marked: bool = False) -> DataFrame:
    """``doc_id, item_id, score, start_word, end_word``: passages whose alignment reaches the share of the item's best score.

    ``marked`` adds ``mark``, 128 bits of the document's text.
    """
    docs = texts(docs)
    key, item_key = docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    item_type = to_arrow_type(items.schema["item_id"].dataType)
    schema = f"doc_id {key}, item_id {item_key}, score double, start_word long, end_word long" + (", mark binary" if marked else "")
    out = docs.sparkSession.createDataFrame([], schema)

    def joined(whole: Block, block: Block) -> DataFrame:
        table, length = block.table(), np.array([len(w) for w in block.words])
        lone, share = bool((length == 1).any()), least_share(length)
        # room for as many inserted words as leave the share
        spare = np.floor(EQUAL * length * (1 - share) / -GAP).astype(np.int64)
        all_words, overlap = whole.table(), Overlap(whole)

        def run(part):
            words = Words(part.column("text"), lower=True)
            at, seed = pair_hits(words, block, table, lone)
            if not len(at):
                return None
            known = hits(words.hash, whole, all_words)
            many = np.diff(block.first)[seed]
            ends = np.cumsum(many)
            left, done = [], 0
            while done < len(at):
                # a seed of many items is expanded in bounded batches
                stop = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + BATCH_HITS, "right")))
                n, first = many[done:stop], block.first[seed[done:stop]]
                which = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
                spot, item = np.repeat(at[done:stop], n), block.item[which]
                begin, row = spot - block.place[which], words.doc[spot]
                # the stretch of the document that the item would cover
                low = np.maximum(begin - spare[item], words.first[row])
                high = np.minimum(begin + length[item] + spare[item], words.first[row + 1])
                # seeds of one alignment without edits ask for the same stretch
                stretch = np.unique(np.stack((row, item, low, high)), axis=1)
                left.append(stretch[:, overlap.enough(*known, stretch[1], stretch[2], stretch[3])])
                done = stop
            row, item, low, high = np.concatenate(left, axis=1)
            if not len(row):
                return None
            order = np.lexsort((low, item, row))
            row, item, low, high = row[order], item[order], low[order], high[order]
            # overlapping stretches of one document and item are one passage
            new = np.concatenate(([True], (row[1:] != row[:-1]) | (item[1:] != item[:-1])))
            group = np.cumsum(new) - 1
            reach = np.maximum.accumulate(high + group * (len(words.hash) + 1)) - group * (len(words.hash) + 1)
            new[1:] |= low[1:] > reach[:-1]
            begin = np.flatnonzero(new)
            row, item, low, high = row[begin], item[begin], low[begin], np.maximum.reduceat(high, begin)
            score = align([words.hash[a:b] for a, b in zip(low, high)], [block.words[k] for k in item]) / (EQUAL * length[item])
            good = np.flatnonzero(score >= share[item])
            if not len(good):
                return None
            item_ids = pa.array([block.ids[k] for k in item[good]], item_type)
            names = ["doc_id", "item_id", "score", "start_word", "end_word"]
            base, rows = words.first[row[good]], pa.array(row[good])
            columns = [part.column("doc_id").take(rows), item_ids, pa.array(score[good]), pa.array(low[good] - base), pa.array(high[good] - base)]
            if marked:
                columns.append(pa.array([text_mark(t) for t in part.column("text").take(rows).to_pylist()], pa.binary()))
                names = [*names, "mark"]
            return pa.RecordBatch.from_arrays(columns, names)

        return by_slice(docs, run, schema)

    for ids, words in blocks(items):
        out = out.unionByName(joined(word_block(ids, words), rarest(docs, pair_block(ids, words))))
    return out


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: ``doc_id, contaminated, n_items, item_ids`` (ascending) and the best ``score`` (0 without a link)."""
    found = links(docs, items).groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("score").alias("best"))
    keys = texts(docs).select("doc_id")
    none = F.array().cast(f"array<{items.schema['item_id'].dataType.simpleString()}>")
    both = keys.join(found.withColumnRenamed("doc_id", "found"), F.col("doc_id").eqNullSafe(F.col("found")), "left")
    return both.select(
        "doc_id", F.col("best").isNotNull().alias("contaminated"), F.coalesce(F.size("item_ids").cast("long"), F.lit(0)).alias("n_items"),
        F.coalesce("item_ids", none).alias("item_ids"), F.coalesce("best", F.lit(0.0)).alias("score"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a link, all columns unchanged.

    A row goes for its own text: other texts of its id, or without an id, stay.
    Only rows whose id may be that of a link are moved.
    """
    gone = settle(links(docs, items, marked=True).select("doc_id", "mark").distinct(), "decontam-ids")
    clear, near = split_by_ids(docs, gone.select("doc_id"))

    def mark(batches):
        for part in slices(batches):
            found = part.column(part.schema.get_field_index("text")).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array([text_mark(t) for t in found.to_pylist()], pa.binary())], [*part.schema.names, "_mark"])

    near = near.mapInArrow(mark, StructType([*docs.schema.fields, StructField("_mark", BinaryType())]))
    gone = gone.select(F.col("doc_id").alias("_gone"), F.col("mark").alias("_with"))
    near = near.join(gone, (F.col("_mark") == F.col("_with")) & F.col("doc_id").eqNullSafe(F.col("_gone")), "left_anti")
    return clear.unionByName(near.select(docs.columns))
