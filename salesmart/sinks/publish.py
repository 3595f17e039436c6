"""Parquet publishing of the marts.

Partitioned writes are rebalanced on the partition columns (the
``rebalance`` hint): rows are hash partitioned by directory, so a task holds
whole directories and writes one file per directory, and AQE splits a
partition that is far above the advisory size (a directory with a third of
all rows goes out from many tasks) and merges small ones.  Unlike a range
layout this needs no sampling pass over the input, and hash placement is the
same when a task is retried.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_RECORDS_PER_FILE = 5_000_000


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path)


def append_files(df: DataFrame, path: str) -> None:
    """Add ``df`` to the table at ``path`` beside other writers.

    Spark's own append stages under ``path`` itself, where writers disturb
    each other; here the files are written aside and then moved in under names
    of their own.  A crash between two moves leaves some of the rows.
    """
    spark = df.sparkSession
    name = uuid.uuid4().hex
    aside = f"{path.rsplit('/', 1)[0]}/_incoming/{name}"
    write_parquet(df, aside)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    for status in fs.listStatus(jvm.org.apache.hadoop.fs.Path(aside)):
        file = status.getPath().getName()
        if file.startswith("part-") and not fs.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(f"{path}/{name}-{file}")):
            raise OSError(f"could not move {file} to {path}")
    remove_path(spark, aside)
    spark.catalog.refreshByPath(path)


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], mode: str = "overwrite", laid_out: bool = False) -> None:
    """Write ``df`` under ``path/c1=../c2=..``; with ``overwrite`` only the
    partitions present in ``df`` are replaced (dynamic partition overwrite).
    A new target needs no staging folder, so it is committed directly.  With
    ``laid_out``, the files that ``df`` reads hold one partition each: they
    are not dealt anew."""
    rows = df if laid_out else df.hint("rebalance", *partition_cols)
    overwrite_mode = "dynamic" if mode == "overwrite" and path_exists(df.sparkSession, path) else "static"
    (
        rows.write.mode(mode)
        .option("partitionOverwriteMode", overwrite_mode)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back with declared types for data and partition columns alike."""
    return spark.read.schema(schema).parquet(path)
