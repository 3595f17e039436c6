"""Session settings and shared locations.

Everything here is plain Spark configuration.  The library reads limits from
the session conf (``salesmart.*`` keys) so a cluster job can tune them with
``--conf`` without code changes.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Size bound for a broadcast dimension.  A side is broadcast only after a
# probe (a count of its rows and bytes) has proven it is below both.
BROADCAST_MAX_ROWS = "salesmart.broadcast.maxRows"
BROADCAST_MAX_BYTES = "salesmart.broadcast.maxBytes"
# Seconds a broadcast decision is reused before the side is probed again.
BROADCAST_PROBE_TTL = "salesmart.broadcast.probeTtlSeconds"

DEFAULTS = {
    BROADCAST_MAX_ROWS: "500000",
    BROADCAST_MAX_BYTES: str(64 * 1024 * 1024),
    BROADCAST_PROBE_TTL: "600",
}

# Spark settings the jobs are written for.  AQE re-plans from real shuffle
# statistics: coalesces small partitions, splits skewed join partitions
# (also when that costs an extra shuffle) and turns a join into a broadcast
# only from *measured* sizes (a shuffle stage's real output, at most 64 MB).  Static broadcast from file-size estimates is
# off: compressed Parquet sizes are not a bound on the in-memory size.
SPARK_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


def conf_int(spark: SparkSession, key: str) -> int:
    return int(spark.conf.get(key, DEFAULTS[key]))


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "salesmart") -> SparkSession:
    """Session for tests and the local benchmark (UI off, no server)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Local disk only: Hadoop's checksummed local file system writes a
        # .crc twin per file; clusters write to HDFS / object stores instead.
        .config("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
        .config("spark.hadoop.fs.file.impl.disable.cache", "true")
    )
    for k, v in SPARK_SETTINGS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a distributed file system path every
    executor can reach).  Only a local-mode session without the setting gets a
    fresh scratch folder of its own, as in tests.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # SparkContext appends a per-application UUID folder; use its parent.
        return current.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS path) for cluster runs")
    root = tempfile.mkdtemp(prefix="salesmart-ckpt-")
    spark.conf.set("spark.checkpoint.dir", root)
    sc.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared checkpoint folder, optionally run-unique."""
    segs = [checkpoint_root(spark), "salesmart", *parts]
    if unique:
        segs.append(uuid.uuid4().hex)
    return "/".join(s.strip("/") if i else s.rstrip("/") for i, s in enumerate(segs))


# For sessions that the job did not build: files of few partitions are written
# side by side instead of sorted, and a join whose one side is small in every
# task (measured) looks rows up instead of sorting both sides.
JOB_SETTINGS = {
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(64 * 1024 * 1024),
}


def job_settings(spark: SparkSession) -> None:
    """Set ``JOB_SETTINGS`` where nobody has set them."""
    for key, value in JOB_SETTINGS.items():
        if not spark.sparkContext.getConf().contains(key):
            spark.conf.set(key, value)


TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Start AQE from about one shuffle partition per 128 MB of input.

    AQE then coalesces small partitions and splits skewed ones; starting too
    low would make every partition of a 100 TB run spill.  A value the user
    set (``--conf``) is left alone.  Returns the partition count in effect.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.sparkContext.getConf().contains(key) or spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions"):
        return int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    floor = spark.sparkContext.defaultParallelism * 2
    n = max(floor, -(-input_bytes // TARGET_PARTITION_BYTES))
    spark.conf.set(key, str(n))
    return n
