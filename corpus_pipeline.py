"""From raw documents to packed training sequences, in five stages.

Every stage takes the rows that its predecessor kept, as Parquet in the shared
folder, and its decisions take effect: low quality goes, one document of each
group of near-duplicates stays, documents that hold a benchmark item go,
secrets are masked, and what is left is packed.  All but the last stage return
the columns of ``documents``.

Nulls, empty texts, repeated rows, extra columns and empty tables are handled
as the operators state: NULL and empty texts are documents that the quality
stage scores; rows of one id, or without one, go only as copies of each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm import decontam, neardup, packing, quality, secrets
from salesmart.llm.common import settle, small_batches, table
from salesmart.llm.queries import tokenizer

#: Quality scores below this go.
LEAST_QUALITY = 0.3


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return quality.keep(docs, table(spark, sf_dir, "labels"), LEAST_QUALITY)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return neardup.deduplicate(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    # the executors still hold what the earlier stages needed: smaller slices, fewer known chunks
    pieces = packing.pack(docs, tokenizer(), capacity=2048, end_id=1, cached=150_000, slice_bytes=1 << 20)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("packing", packed),
]

#: No SQL expresses the trained classifier or the tokenizer: the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
