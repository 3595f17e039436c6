"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import alignment, decontam, entities, extraction, lm, neardup, packing, quality, ranking, repeats, rules, secrets, tokenfiles
from salesmart.llm.common import table


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer(), capacity=2048, end_id=1)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_quality_rff(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.round_trip(table(spark, sf_dir, "documents"), tokenizer(), end_id=2)


def op5_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), quality.held_out(7, 2))


def op6_seed_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.apply_policy(rules.ledger(table(spark, sf_dir, "documents")), "v1")
    base = rules.apply_policy(rows, "base", "base_kept")
    return base.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~F.col("base_kept")).alias("base_failed"), "kept")


def op8_boosted_dom(spark: SparkSession, sf_dir: str) -> DataFrame:
    main = extraction.extract(table(spark, sf_dir, "pages"))
    return main.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op10_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.scan(table(spark, sf_dir, "documents"))


def op12_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), a, b)


def op13_length_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_harmonic_packing": op1_harmonic_packing,
    "op2_super_kmers": op2_super_kmers,
    "op3_quality_rff": op3_quality_rff,
    "op4_token_shards": op4_token_shards,
    "op5_recurrent_lm": op5_recurrent_lm,
    "op6_seed_alignment": op6_seed_alignment,
    "op7_rule_ledger": op7_rule_ledger,
    "op8_boosted_dom": op8_boosted_dom,
    "op9_secret_novelty": op9_secret_novelty,
    "op10_chosen_path": op10_chosen_path,
    "op11_skip_chain": op11_skip_chain,
    "op12_token_links": op12_token_links,
    "op13_length_strata": op13_length_strata,
}

ORACLE: dict[str, str] = {"op7_rule_ledger": rules.ORACLE, "op13_length_strata": ranking.ORACLE}
