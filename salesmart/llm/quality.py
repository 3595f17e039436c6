"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

Each document becomes a vector of statistics of its whole text.  Random
Fourier features of the standardised vector approximate a Gaussian kernel, so
a ridge regression on them is a kernel regression whose normal equations have
a fixed size: every partition sums its own, and the sums are added up row by
row on the executors.  The ridge values are turned into probabilities by
isotonic regression over a histogram of the training rows.

NULL and empty texts have zero statistics and are scored like any other.
Without training labels every score is 0.5.  Several labels of one document
are averaged; a NULL label, or a label without a document, is not used.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import Words, by_slice, gram_hashes, inside, settle, split_by_ids, temporary, texts

#: Byte classes of the statistics, in order: lower-case, upper-case, digit,
#: white space but \n, \n, full stop or comma, other ASCII punctuation, bar,
#: control, part of a character beyond ASCII.
_CLASS = np.zeros(256, np.uint8)
_CLASS[32:127] = 6
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[9, 11, 12, 13, 32]], _CLASS[10], _CLASS[[44, 46]], _CLASS[124] = 3, 4, 5, 7
_CLASS[:9], _CLASS[14:32], _CLASS[127], _CLASS[128:] = 8, 8, 8, 9
CLASSES = 10
FEATURES = 27
#: Random features, ridge penalty for each training row, kernel width in standard deviations.
RANDOM, RIDGE, WIDTH, SEED = 256, 1e-3, 4.0, 20250


def _ratio(a, b):
    return a / np.maximum(b, 1)


def _largest(doc: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: distinct keys, the count of the commonest, and the sum of count * log(count)."""
    distinct, top, entropy = np.zeros(n), np.zeros(n), np.zeros(n)
    if len(key):
        order = np.lexsort((key, doc))
        doc, key = doc[order], key[order]
        new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])))
        at = np.flatnonzero(new)
        count = np.diff(np.concatenate((at, [len(key)])))
        owner = doc[at]
        distinct = np.bincount(owner, minlength=n).astype(float)
        np.maximum.at(top, owner, count)
        entropy = np.bincount(owner, count * np.log(count), minlength=n)
    return distinct, top, entropy


def statistics(column: pa.Array) -> np.ndarray:
    """The statistics of each text (rows x FEATURES)."""
    words = Words(column)
    n = words.n
    size = np.diff(words.bounds)
    owner = np.repeat(np.arange(n), size)
    kinds = np.bincount(owner * CLASSES + _CLASS[words.data], minlength=n * CLASSES).reshape(n, CLASSES).astype(float)
    count = np.diff(words.first).astype(float)
    length = (words.end - words.start).astype(float)
    mean = _ratio(np.bincount(words.doc, length, n), count)
    spread = np.sqrt(np.maximum(_ratio(np.bincount(words.doc, length**2, n), count) - mean**2, 0))
    first = _CLASS[words.data[words.start]] if len(words.start) else np.zeros(0)
    last = _CLASS[words.data[words.end - 1]] if len(words.start) else np.zeros(0)
    distinct, top, entropy = _largest(words.doc, words.hash, n)
    entropy = np.where(count > 0, np.log(np.maximum(count, 1)) - _ratio(entropy, count), 0)
    fit = inside(words, 3)
    grams, _, _ = _largest(words.doc[: len(fit)][fit], gram_hashes(words.hash, 3)[fit], n)
    same = np.zeros(0, bool)
    if len(words.doc) > 1:
        same = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    # lines: rows of words between line feeds
    feeds = np.concatenate(([0], np.cumsum(words.data == 10)))
    lines = np.zeros(n)
    repeated = np.zeros(n)
    if len(words.start):
        line = feeds[words.start]
        begins = np.concatenate(([True], (line[1:] != line[:-1]) | (words.doc[1:] != words.doc[:-1])))
        at = np.flatnonzero(begins)
        key = np.add.reduceat(words.hash * (2 * np.arange(len(words.hash)).astype(np.uint64) - 2 * np.repeat(at, np.diff(np.concatenate((at, [len(begins)])))).astype(np.uint64) + np.uint64(1)), at)
        lines = np.bincount(words.doc[at], minlength=n).astype(float)
        repeated = lines - _largest(words.doc[at], key, n)[0]
    out = np.column_stack([
        np.log1p(size), np.log1p(count), mean, spread,
        *(_ratio(kinds[:, k], size) for k in range(CLASSES)),
        _ratio(np.bincount(words.doc, first == 1, n), count),
        _ratio(np.bincount(words.doc, last == 5, n), count),
        _ratio(np.bincount(words.doc, last == 6, n), count),
        _ratio(np.bincount(words.doc, (first == 7) | (first == 6), n), count),
        _ratio(np.bincount(words.doc, length <= 3, n), count),
        _ratio(distinct, count), _ratio(top, count), entropy,
        _ratio(grams, np.maximum(count - 2, 0)),
        _ratio(np.bincount(words.doc[1:], same, n) if len(same) else np.zeros(n), count),
        np.log1p(_ratio(count, lines)), _ratio(repeated, lines),
        _ratio(kinds[:, 1], kinds[:, 0] + kinds[:, 1]),
    ])
    return out.astype(np.float32)


def features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and its statistics ``f`` (array of float), one row per document."""
    docs = texts(docs)

    def run(part):
        f = statistics(part.column("text"))
        flat = pa.array(f.ravel(), pa.float32())
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(np.arange(len(f) + 1) * FEATURES, pa.int32()), flat)], ["doc_id", "f"])

    return by_slice(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, f array<float>")


#: Rows of a block that is scored at once.
ROWS = 64


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def random_features(self, f: np.ndarray) -> np.ndarray:
        x = np.clip((f - self.mean) / self.scale, -5, 5)
        z = np.cos(x @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.column_stack([z, np.ones(len(z))])

    def raw(self, f: np.ndarray) -> np.ndarray:
        return self.random_features(f) @ self.weights

    def score(self, f: np.ndarray) -> np.ndarray:
        # whole blocks of rows: a text's score does not depend on how many share its batch
        whole = np.vstack([f, np.zeros((-len(f) % ROWS, f.shape[1]), f.dtype)])
        return np.interp(self.raw(whole)[: len(f)], self.knots, self.levels)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("f").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, FEATURES).astype(np.float64)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over points sorted by ``x``: knots and non-decreasing levels."""
    blocks: list[list[float]] = []  # mean x, mean y, weight
    for a, b, c in zip(x.tolist(), y.tolist(), w.tolist()):
        blocks.append([a, b, c])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            a2, b2, c2 = blocks.pop()
            a1, b1, c1 = blocks[-1]
            blocks[-1] = [(a1 * c1 + a2 * c2) / (c1 + c2), (b1 * c1 + b2 * c2) / (c1 + c2), c1 + c2]
    return np.array([b[0] for b in blocks]), np.array([b[1] for b in blocks])


def fit(feats: DataFrame, labels: DataFrame, bins: int = 2000) -> Model | None:
    """Fit on every row of ``labels`` (``doc_id, label``); None without any.

    What reaches the driver has a fixed size: the statistics' means, the
    normal equations (RANDOM + 1 rows) and the histogram of raw values.
    """
    marked = labels.where("label IS NOT NULL").groupBy("doc_id").agg(F.avg("label").alias("label"))
    train = settle(feats.join(marked, "doc_id").select("f", "label"), "quality-train")
    moments = train.select(F.count(F.lit(1)).alias("n"), *(g(F.col("f")[k]).alias(f"{g.__name__}{k}") for k in range(FEATURES) for g in (F.avg, F.stddev_pop))).first()
    if not moments["n"]:
        return None
    mean = np.array([moments[f"avg{k}"] for k in range(FEATURES)])
    scale = np.maximum(np.array([moments[f"stddev_pop{k}"] for k in range(FEATURES)]), 1e-6)
    rng = np.random.default_rng(SEED)
    empty = np.zeros(0)
    model = Model(mean, scale, rng.normal(size=(FEATURES, RANDOM)) / WIDTH, rng.uniform(0, 2 * np.pi, RANDOM), empty, empty, empty)
    size = RANDOM + 1

    def equations(batches):
        left, right = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            z = model.random_features(_matrix(batch))
            left += z.T @ z
            right += z.T @ batch.column("label").to_numpy(zero_copy_only=False)
        if left[-1, -1]:
            rows = np.column_stack([left, right])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int64()), pa.array([r.tobytes() for r in rows], pa.binary())], ["row", "sums"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, raw in zip(batch.column("row").to_pylist(), batch.column("sums").to_pylist()):
                part = np.frombuffer(raw)
                sums[row] = sums[row] + part if row in sums else part
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["row", "sums"])

    rows = train.mapInArrow(equations, "row long, sums binary").repartition("row").mapInArrow(add, "row long, sums binary").collect()
    system = np.vstack([np.frombuffer(r["sums"]) for r in sorted(rows, key=lambda r: r["row"])])
    left, right = system[:, :-1], system[:, -1]
    penalty = np.full(size, RIDGE * moments["n"] / RANDOM + 1e-6)
    penalty[-1] = 1e-9
    model.weights = np.linalg.solve(left + np.diag(penalty), right)

    def histogram(batches):
        for batch in batches:
            at = np.round(np.clip(model.raw(_matrix(batch)), -1, 2) * bins).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("label")], ["at", "label"])

    spots = train.mapInArrow(histogram, "at long, label double").groupBy("at").agg(F.avg("label").alias("y"), F.count(F.lit(1)).alias("w")).collect()
    spots.sort(key=lambda r: r["at"])
    model.knots, model.levels = isotonic(np.array([r["at"] for r in spots]) / bins, np.array([r["y"] for r in spots]), np.array([r["w"] for r in spots], float))
    return model


def apply(feats: DataFrame, model: Model | None) -> DataFrame:
    """``feats`` with ``score`` (0 to 1) instead of the statistics."""
    if model is None:
        return feats.withColumn("score", F.lit(0.5)).drop("f")
    names = [c for c in feats.columns if c != "f"]
    schema = ", ".join(f"`{c}` {feats.schema[c].dataType.simpleString()}" for c in names) + ", score double"

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(model.score(_matrix(batch)))], [*names, "score"])

    return feats.mapInArrow(run, schema)


def held_out(modulus: int, remainder: int):
    """True where crc32 of ``doc_id`` as text leaves ``remainder``; a NULL id is never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(True))


def _marked(labels: DataFrame, label: str) -> DataFrame:
    return labels.select("doc_id", F.col(label).cast("double").alias("label")).where(~held_out(5, 0))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality") -> tuple[DataFrame, Model | None]:
    """All documents' statistics, and the model of the labels of documents that are not held out."""
    feats = settle(features(docs).withColumn("held_out", held_out(5, 0)), "quality-features")
    with temporary(docs.sparkSession):
        return feats, fit(feats, _marked(labels, label))


def score(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """``doc_id, held_out, score``, learning from the labels of documents that are not held out."""
    return apply(*learn(docs, labels, label))


def keep(docs: DataFrame, labels: DataFrame, least: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, all columns unchanged."""
    marked = _marked(labels, "quality")
    with temporary(docs.sparkSession):
        # statistics of documents that have a label, and of few others
        _, labelled = split_by_ids(texts(docs), marked.where("label IS NOT NULL").select("doc_id").distinct())
        model = fit(features(labelled), marked)
    if model is None:
        return docs if least <= 0.5 else docs.limit(0)

    def run(part):
        scores = model.score(statistics(part.column(part.schema.get_field_index(text))).astype(np.float64))
        return part.filter(pa.array(scores >= least))

    return by_slice(docs, run, docs.schema, text)
