from collections import Counter

import duckdb
import pytest

from brute import WORD
from salesmart.llm import rules
from salesmart.llm.queries import ORACLE, QUERIES


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_query_against_plain_measurements_and_oracle(spark, sf):
    docs = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    df = QUERIES["op7_rule_ledger"](spark, sf)
    rows = sorted(map(tuple, df.collect()))
    assert {r[0]: r[1:6] for r in rows} == {d: plain(t) for d, t in docs.items()}
    assert all(r[6] == (r[1] < 50 or 100 * r[5] > 50 * r[1]) and not (r[6] and r[7]) for r in rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    result = con.execute(ORACLE["op7_rule_ledger"])
    assert [c[0] for c in result.description] == df.columns
    assert sorted(map(tuple, result.fetchall())) == rows


def test_good_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op7_rule_ledger"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("NOT base_failed").collect()
    assert all(r["kept"] for r in rows if r["quality"] == 1)
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(bad) < 0.2 * len(bad)


@pytest.mark.parametrize("text", [
    None, "", " \n ", "a", "a b", "a b c", "a b c a b c", "a a a", "a a a a", "a b a b a b", "\n\nx\n x\nx\n\nx", "é #|& ß\x1c y", "A!! B!! " * 40,
    "a b c d e a b c x a b", "w " * 200, "#" * 100,
])
def test_texts(spark, text):
    row = rules.measurements(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == plain(text)


def test_policies_and_ablation(spark, odd):
    book = rules.ledger(odd).cache()
    rows = book.collect()
    assert len(rows) == odd.count()
    kept = {r["doc_id"]: r["kept"] for r in rules.apply_policy(book, "v1").collect()}
    assert kept[1] is False and kept[2] is False and kept[9] is False
    table = {r["rule"]: r for r in rules.ablation(book, "v1").collect()}
    total = rules.mask("v1")
    for name, r in table.items():
        bit = 1 << rules.BITS[name]
        assert r["failing"] == sum(bool(x["failed"] & bit) for x in rows)
        assert r["only_this"] == sum(x["failed"] & total == bit for x in rows)
        assert r["kept_without"] == sum(x["failed"] & total & ~bit == 0 for x in rows)
    book.unpersist()
    assert rules.ledger(odd.limit(0)).count() == 0
    assert rules.apply_policy(rules.ledger(odd), ("bars",)).where("NOT kept").count() == 0


def test_no_python_in_the_plan(spark, sf):
    plan = QUERIES["op7_rule_ledger"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Exchange"))
