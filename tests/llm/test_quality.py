import zlib

import numpy as np
import pyarrow as pa

from salesmart.llm import quality
from salesmart.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op3_quality_rff"](spark, sf).toPandas()
    assert sorted(got.doc_id) == list(range(10_000))
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    both = got.merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    both = both[both.held_out]
    assert (both.predicted == both.quality).mean() > 0.97
    assert both[both.quality == 1].predicted.mean() > 0.99
    assert both[both.quality == 0].predicted.mean() < 0.1


def test_odd_rows_and_labels(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, None), (7, 0), (9, 1), (8, 1), (77, 1), (None, 0)], "doc_id long, quality int")
    rows = quality.score(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    same = [r["score"] for r in rows if r["doc_id"] == 6]
    assert same[0] == same[1]
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [True]


def test_no_labels_and_empty_table(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.score(odd, none).collect()} == {0.5}
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert quality.score(odd.limit(0), labels).count() == 0


def test_statistics_of_known_texts():
    texts = ["", None, "The The The The\nThe The The The", "aé B, 12 | ab. AB", "x" * 200 + " " + "y" * 200]
    f = quality.statistics(pa.array(texts))
    assert f.shape == (5, quality.FEATURES) and np.isfinite(f).all()
    assert np.allclose(f[0], 0) and np.allclose(f[1], 0)
    assert np.isclose(np.expm1(f[2, 1]), 8) and np.isclose(f[2, 19], 1 / 8) and np.isclose(f[2, 20], 1)
    assert np.isclose(f[2, 25], 0.5)  # one of two lines repeats the other
    alone = quality.statistics(pa.array([texts[3]]))
    assert np.allclose(alone[0], f[3])


def test_isotonic_is_monotone_and_keeps_the_mean():
    rng = np.random.default_rng(1)
    x, w = np.sort(rng.random(500)), rng.integers(1, 9, 500).astype(float)
    y = (rng.random(500) < x).astype(float)
    knots, levels = quality.isotonic(x, y, w)
    assert (np.diff(levels) > 0).all() and (np.diff(knots) > 0).all()
    brute = max(min(np.average(y[a:b], weights=w[a:b]) for b in range(250, 501)) for a in range(0, 250))
    at = np.searchsorted(np.cumsum(w), w[:250].sum())
    assert at == 249 and any(np.isclose(levels, brute))
