"""The ledger's finished versions as a bucketed base and a small delta.

The base is bucketed and sorted by the version's hash, so a listing that is
dealt into as many partitions by the same hash joins it bucket by bucket: the
history is read where it lies and never shuffled, however long it grows.
What was finished since the base was written is the delta, joined as any small
side.  ``compact`` writes both as the next base under a new name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.joins import join_dimension

KEY = "version"


def version_of(*columns: str) -> Column:
    """128 bits of the columns that make a version (NULLs are values)."""
    parts = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in columns]
    return F.md5(F.concat_ws("\x00", *parts).cast("binary"))


def write_base(done: DataFrame, table: str, path: str, buckets: int) -> None:
    """Write the distinct ``version`` of ``done`` as a bucketed table at ``path``."""
    rows = done.select(KEY).distinct().repartition(buckets, KEY)
    rows.write.mode("errorifexists").format("parquet").option("path", path).bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(table)


def open_base(spark: SparkSession, table: str, path: str, buckets: int) -> DataFrame:
    """The base at ``path``, registered again in a session that does not know it."""
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {table} ({KEY} STRING) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def not_in_base(listing: DataFrame, base: DataFrame, delta: DataFrame, buckets: int) -> DataFrame:
    """Rows of ``listing`` (with ``version``) that neither base nor delta has; only the listing moves."""
    fresh = join_dimension(listing, delta.select(KEY).distinct(), KEY, "left_anti")
    return fresh.repartition(buckets, KEY).join(base.hint("merge"), KEY, "left_anti")


def compact(spark: SparkSession, base: DataFrame, delta: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    write_base(base.select(KEY).unionByName(delta.select(KEY)), table, path, buckets)
    return spark.table(table)
