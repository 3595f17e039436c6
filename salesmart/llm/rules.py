"""Quality rules as a bitmask ledger, in DataFrame expressions only.

Every rule is evaluated once on every document's whole text.  The ledger keeps
the measurements and one integer whose bit k says that rule k failed.  A
policy is a mask of rules with a version; applying one, comparing two, or
asking what a rule alone removes are integer operations on the ledger and
never read a text again.

NULL and empty texts have zero measurements and fail ``few_words``.  Repeated
rows are judged once each.  An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import NOT_WORD_SQL

#: Fixed characters: symbols that are counted, and letters for the share of capitals.
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SMALL = CAPITALS.lower()
REPEAT = 3  # words of a window whose repetition counts


@dataclass(frozen=True)
class Rule:
    """Fails where ``failed`` (SQL over the measurements) holds."""

    name: str
    failed: str


#: Bit k of the ledger is rule k: rules are only ever added at the end.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("many_symbols", "n_symbols > n_words"),
    Rule("capitals", "n_capitals > 20 AND 10 * n_capitals > 7 * (n_capitals + n_small)"),
    Rule("exclamations", "n_exclaims > 20 AND 2 * n_exclaims > n_words"),
    Rule("duplicate_lines", "n_dup_lines >= 5 AND 2 * n_dup_lines > n_lines"),
    Rule("bars", "n_bars > 10 AND 4 * n_bars > n_words"),
    Rule("word_length", "n_words >= 50 AND (word_chars < 2 * n_words OR word_chars > 25 * n_words)"),
)
BITS = {rule.name: k for k, rule in enumerate(RULES)}

#: Versioned policies: the rules that drop a document.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "many_symbols", "capitals", "exclamations", "duplicate_lines", "bars", "word_length"),
}


def mask(policy: str | tuple[str, ...]) -> int:
    return sum(1 << BITS[name] for name in (POLICIES[policy] if isinstance(policy, str) else policy))


def _count(chars: str, text: Column) -> Column:
    """Characters of ``text`` that are among ``chars``."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _repeated_words(words: Column) -> Column:
    """Words covered by windows of REPEAT words that occur twice or more."""
    # a window's words as one hash: 64 bits tell the windows of one text apart
    starts = F.when(F.size(words) >= REPEAT, F.sequence(F.lit(0), F.size(words) - REPEAT)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(REPEAT))))
    placed = lambda w: F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("w"), i.alias("i"))))
    same = lambda s, x, other: F.coalesce(x["w"] == F.get(s, other)["w"], F.lit(False))

    def covered(s: Column) -> Column:
        # equal windows are neighbours once sorted; at ascending starts each adds what the one before has not covered
        twice = F.filter(F.transform(s, lambda x, k: F.when(same(s, x, k - 1) | same(s, x, k + 1), x["i"])), lambda i: i.isNotNull())
        none = F.struct(F.lit(-REPEAT).alias("last"), F.lit(0).cast("long").alias("n"))
        add = lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(REPEAT), i - acc["last"])).alias("n"))
        return F.aggregate(F.array_sort(twice), none, add, lambda acc: acc["n"])

    # most texts repeat nothing and need no sort
    return _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), _let(placed(w), covered)).otherwise(F.lit(0).cast("long")))


def measurements(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id`` and the measurements of each whole text."""
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    t = F.col("text")
    words = F.filter(F.split(t, NOT_WORD_SQL), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    of_words = _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeated_words(w).alias("n_repeat_words")))
    of_lines = _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    all_of = F.struct(
        of_words.alias("by_word"), of_lines.alias("by_line"), F.length(F.regexp_replace(t, NOT_WORD_SQL, "")).cast("long").alias("word_chars"),
        _count(SYMBOLS, t).alias("n_symbols"), _count(CAPITALS, t).alias("n_capitals"), _count(SMALL, t).alias("n_small"),
        _count("!", t).alias("n_exclaims"), _count("|", t).alias("n_bars"),
    )
    # as a generated row, so that no filter on a measurement is pushed below and measures the text again
    rows = rows.select("doc_id", F.inline(F.array(all_of)))
    return rows.select("doc_id", "by_word.*", "by_line.*", "word_chars", "n_symbols", "n_capitals", "n_small", "n_exclaims", "n_bars")


def ledger(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The measurements and ``failed``, the bits of the rules that fail."""
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(rule.failed), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return measurements(docs, text, key).withColumn("failed", bits)


def apply_policy(rows: DataFrame, policy: str | tuple[str, ...], name: str = "kept") -> DataFrame:
    """``rows`` of a ledger with the policy's verdict."""
    return rows.withColumn(name, F.col("failed").bitwiseAND(F.lit(mask(policy))) == 0)


def ablation(rows: DataFrame, policy: str | tuple[str, ...]) -> DataFrame:
    """Per rule of the policy: documents that fail it, that only it drops, and that the policy keeps without it.

    The ledger is first counted by its bits (at most two to the number of
    rules different rows), so the rules meet counts and not documents.
    """
    wanted = POLICIES[policy] if isinstance(policy, str) else policy
    total = mask(policy)
    counts = rows.groupBy(F.col("failed").bitwiseAND(F.lit(total)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    each = F.explode(F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(1 << BITS[name]).cast("long").alias("bit")) for name in wanted)))
    counts = counts.select("bits", "n", each.alias("r")).select("bits", "n", "r.rule", "r.bit")
    has = F.col("bits").bitwiseAND(F.col("bit")) != 0
    alone = F.col("bits") == F.col("bit")
    sums = {"failing": has, "only_this": alone, "kept_without": (F.col("bits") == 0) | alone}
    return counts.groupBy("rule").agg(*(F.sum(F.when(c, F.col("n")).otherwise(0)).alias(name) for name, c in sums.items()))


#: DuckDB SQL of the ledger under policy v1, for the table ``documents``.
ORACLE = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
r AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, i AS p FROM d UNION ALL SELECT doc_id, i + 1 FROM d UNION ALL SELECT doc_id, i + 2 FROM d) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS BIGINT) AS n_capitals,
         CAST(length(t) - length(translate(t, 'abcdefghijklmnopqrstuvwxyz', '')) AS BIGINT) AS n_small,
         CAST(length(t) - length(translate(t, '!', '')) AS BIGINT) AS n_exclaims,
         CAST(length(t) - length(translate(t, '|', '')) AS BIGINT) AS n_bars
  FROM w LEFT JOIN r ON w.doc_id = r.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_symbols > n_words
            OR (n_capitals > 20 AND 10 * n_capitals > 7 * (n_capitals + n_small))
            OR (n_exclaims > 20 AND 2 * n_exclaims > n_words)
            OR (n_dup_lines >= 5 AND 2 * n_dup_lines > n_lines)
            OR (n_bars > 10 AND 4 * n_bars > n_words)
            OR (n_words >= 50 AND (word_chars < 2 * n_words OR word_chars > 25 * n_words))) AS kept
FROM m
"""
