import numpy as np
import pytest

from brute import LOWER, WORD
from salesmart.llm import decontam
from salesmart.llm.queries import QUERIES


def smith_waterman(a, b):
    """The plain recurrence, cell by cell."""
    best, above = 0, [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for k, y in enumerate(b):
            now.append(max(0, above[k] + (2 if x == y else -1), above[k + 1] - 1, now[k] - 1))
        best, above = max(best, *now), now
    return best


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    """Every document aligned with every item that shares a 5-gram with it."""
    grams = {}
    for item, text in items:
        w = words(text)
        for k in range(len(w) - 4):
            grams.setdefault(tuple(w[k : k + 5]), set()).add(item)
    texts, out = dict(items), {}
    for doc, text in docs:
        w = words(text)
        for item in sorted({i for k in range(len(w) - 4) for i in grams.get(tuple(w[k : k + 5]), ())}):
            score = smith_waterman(words(texts[item]), w) / (2 * len(words(texts[item])))
            if score >= 0.5:
                out.setdefault(doc, {})[item] = score
    return out


def test_query_against_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute(docs, items)
    rows = QUERIES["op6_seed_alignment"](spark, sf).collect()
    assert len(rows) == len(docs) and want
    for r in rows:
        found = want.get(r["doc_id"], {})
        assert r["item_ids"] == sorted(found) and r["n_items"] == len(found) and r["contaminated"] == bool(found)
        assert np.isclose(r["score"], max(found.values(), default=0))


def test_edited_copies(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{k}" for k in range(3000)]
    item = [vocabulary[k] for k in rng.integers(0, 3000, 60)]
    noise = lambda n: [vocabulary[k] for k in rng.integers(0, 3000, n)]
    changed, inserted, dropped = list(item), [], [w for k, w in enumerate(item) if k % 9]
    for k in range(7, 60, 9):
        changed[k] = "zzz"
    for k, w in enumerate(item):
        inserted += [w] + ["yyy"] * (k % 8 == 7)
    texts = {1: item, 2: changed, 3: inserted, 4: dropped, 5: noise(60), 6: item[:35], 7: item[:20], 8: [w.upper() for w in item], 9: noise(200) + item + noise(3000) + changed}
    docs = spark.createDataFrame([(k, " ".join(noise(k * 40) + t + noise(50))) for k, t in texts.items()], "doc_id long, text string")
    items = spark.createDataFrame([(70, " ".join(item)), (71, " ".join(item)), (72, "too short"), (73, None), (74, "")], "item_id int, text string")
    rows = {r["doc_id"]: r["item_ids"] for r in decontam.report(docs, items).collect()}
    assert rows == {1: [70, 71], 2: [70, 71], 3: [70, 71], 4: [70, 71], 5: [], 6: [70, 71], 7: [], 8: [70, 71], 9: [70, 71]}
    spans = {(r["start_word"] <= 40, r["end_word"] >= 100) for r in decontam.links(docs, items).where("doc_id = 1").collect()}
    assert spans == {(True, True)}


def test_lone_edited_copies_against_all_alignments(spark):
    """One densely edited copy of each item, whose intact words stand nowhere else."""
    rng = np.random.default_rng(8)
    noise = lambda n: [f"n{k}" for k in rng.integers(0, 500, n)]
    items, docs = [], []
    for number in range(48):
        item = [f"i{number}x{k}" if rng.random() < 0.7 else f"n{rng.integers(500)}" for k in range(int(rng.integers(15, 60)))]
        every, copy = 2 + number // 4 % 6, []
        for k, w in enumerate(item):
            new = f"e{number}x{k}"
            copy += [w] if k % every != every - 1 else ([new], [w, new], [], [w] + [new] * (k % 3))[number % 4]
        items.append((number, " ".join(item)))
        docs.append((number, " ".join(noise(40) + copy + noise(40))))
    # 20 words, the 7th and the 14th changed: 6 of 16 5-grams intact
    words_20 = [f"q{k}" for k in range(20)]
    items.append((48, " ".join(words_20)))
    docs.append((48, " ".join(noise(30) + [f"z{k}" if k in (6, 13) else w for k, w in enumerate(words_20)] + noise(30))))
    want = {}
    for doc, text in docs:
        for item, question in items:
            score = smith_waterman(words(question), words(text)) / (2 * len(words(question)))
            if score >= 0.5:
                want.setdefault(doc, {})[item] = score
    assert len(want) > 35 and want[48] == {48: 0.85}
    tables = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.report(*tables).collect()
    assert {r["doc_id"]: r["item_ids"] for r in rows if r["contaminated"]} == {d: sorted(found) for d, found in want.items()}
    assert all(np.isclose(r["score"], max(want.get(r["doc_id"], {0: 0}).values())) for r in rows)


def test_short_items_word_for_word(spark):
    items = {1: "Alpha", 2: "beta gamma", 3: "one two three four", 4: "two two", 5: " ", 6: "one two three four five"}
    texts = {
        10: "x alpha y", 11: "alphas", 12: "beta x gamma", 13: "q beta GAMMA", 14: "one two three x four", 15: "zero one two three four",
        16: "two three two", 17: "x two two two", 18: "beta", 19: "gamma beta", 20: "", 21: None, 22: "one two zzz four five", 23: "gamma",
    }
    want = {10: [1], 13: [2], 14: [6], 15: [3, 6], 17: [4], 22: [6]}
    tables = (spark.createDataFrame(list(t.items()), f"{k} long, text string") for k, t in (("doc_id", texts), ("item_id", items)))
    rows = decontam.report(*tables).collect()
    assert {r["doc_id"]: r["item_ids"] for r in rows if r["contaminated"]} == want and len(rows) == len(texts)


def test_common_words_of_many_items_in_bounded_memory(spark, monkeypatch):
    """Items of common words only against all alignments; what a slice holds at once stays below the bound."""
    rng = np.random.default_rng(14)
    word = lambda n: [f"z{int(k) % 60}" for k in rng.zipf(1.3, n)]
    items = [(k, " ".join(word(8))) for k in range(150)]
    docs = [(k, " ".join(word(120))) for k in range(12)]
    want = {}
    for doc, text in docs:
        found = {i: smith_waterman(words(q), words(text)) / 16 for i, q in items}
        want[doc] = [i for i, score in found.items() if score >= 0.5]
    tables = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, decontam.links(*tables).collect()))
    assert {r["doc_id"]: r["item_ids"] for r in decontam.report(*tables).collect()} == want
    monkeypatch.setattr(decontam, "BATCH_HITS", 500)
    assert sorted(map(tuple, decontam.links(*tables).collect())) == whole


@pytest.mark.parametrize("seed", range(3))
def test_alignment_against_the_recurrence(seed):
    rng = np.random.default_rng(seed)
    passages = [rng.integers(0, 6, rng.integers(1, 60)).astype(np.uint64) for _ in range(40)]
    items = [rng.integers(0, 6, rng.integers(1, 40)).astype(np.uint64) for _ in range(40)]
    assert decontam.align(passages, items).tolist() == [smith_waterman(i.tolist(), p.tolist()) for p, i in zip(passages, items)]


def test_blocks_of_items_give_the_same(spark, sf, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, decontam.links(docs, items).collect()))
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 400)
    assert sorted(map(tuple, decontam.links(docs, items).collect())) == whole


def test_odd_rows(spark, odd):
    items = spark.createDataFrame([(1, "fox jumps over the lazy dog"), (2, "no id here")], "item_id long, text string")
    rows = decontam.report(odd, items).collect()
    assert len(rows) == odd.count()
    # the short item stands word for word in the text without an id
    assert {r["doc_id"] for r in rows if r["contaminated"]} == {None, 1, 6}
    left = decontam.clean(odd, items)
    assert left.columns == odd.columns and left.count() == odd.where("doc_id IS NOT NULL AND doc_id NOT IN (1, 6)").count()
    # a row goes for its own text only
    more = odd.unionByName(odd.where("doc_id = 5").selectExpr("* EXCEPT (doc_id)", "explode(array(NULL, 1L)) AS doc_id"))
    assert sorted(str(r["doc_id"]) for r in decontam.clean(more, items).where("text = 'one'").collect()) == ["1", "5", "None"]
    assert decontam.clean(odd, items.where("item_id = 1")).count() == odd.count() - 3
    assert decontam.report(odd.limit(0), items).count() == 0
    assert decontam.report(odd, items.limit(0)).where("contaminated").count() == 0
