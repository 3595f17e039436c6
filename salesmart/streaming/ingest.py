"""Incremental ingest as a Structured Streaming query.

The stream is the file listing of the drop (``binaryFile`` source, content
column never selected, so no file is read by the stream itself).  Each
micro-batch is the set of files that appeared since the last one; it runs
the batch job on exactly that listing through ``foreachBatch``.  The stream
checkpoint remembers which files were offered, the run ledger which were
finished, so a rerun with no new file starts no batch and a replayed batch
counts no file twice.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salesmart.plans import job
from salesmart.plans.ingest import NoValidFile
from salesmart.sources.files import file_name_of

log = logging.getLogger("salesmart.stream")

# The binaryFile source's fixed schema (a stream source must be given one).
BINARY_FILE = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType(), True),
    ]
)


def file_stream(spark: SparkSession, drop_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(drop_dir).select(
        F.col("path").alias("file_location"),
        file_name_of(F.col("path")).alias("file_name"),
        "length",
        F.col("modificationTime").alias("modification_time"),
    )


def start(
    spark: SparkSession,
    drop_dir: str,
    out_dir: str,
    dims: job.Dimensions,
    checkpoint_dir: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    jdbc=None,
) -> StreamingQuery:
    """Start the ingest stream; with ``available_now`` it processes what is
    in the drop and stops."""

    def each_batch(listing: DataFrame, epoch_id: int) -> None:
        if listing.isEmpty():
            return
        try:
            job.run(spark, drop_dir, out_dir, dims, jdbc=jdbc, listing=listing)
        except NoValidFile as nothing:
            # only files set aside, or a replayed batch that is done already
            log.info("batch %d: %s", epoch_id, nothing)

    writer = (
        file_stream(spark, drop_dir, max_files_per_trigger)
        .writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint_dir)
        .queryName(f"salesmart_ingest_{abs(hash(drop_dir)) % 10**8}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
