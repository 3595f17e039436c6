import datetime as dt

from pyspark.sql import functions as F

from salesmart.config import shared_path
from salesmart.operators.joins import fits_broadcast, join_dimension
from salesmart.operators.ledger import already_done, latest_state, not_done
from salesmart.sinks.publish import read_partitioned, write_partitioned
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)


def test_broadcast_probe_respects_bounds(spark):
    small = spark.range(100)
    assert fits_broadcast(small, max_rows=100, max_bytes=10_000)
    assert not fits_broadcast(small, max_rows=99, max_bytes=10_000)
    assert not fits_broadcast(small, max_rows=1000, max_bytes=100)
    spark.conf.set("salesmart.broadcast.maxRows", "1000")
    try:
        plan = join_dimension(spark.range(10).withColumnRenamed("id", "k"), spark.range(40_000).withColumnRenamed("id", "k"), "k")
        assert "BroadcastHashJoin" not in plan._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("salesmart.broadcast.maxRows")


def test_latest_state_breaks_ties_on_second_order_column(spark):
    ledger = spark.createDataFrame(
        [("a.csv", "A", T0, 1), ("a.csv", "I", T0, 2), ("b.csv", "A", T0, 3), ("c.csv", "I", T0, 1),
         ("c.csv", "A", T0.replace(hour=5), 0)],
        "file_name string, status string, event_ts timestamp, run_id long",
    )
    got = rows(latest_state(ledger, "file_name", ["event_ts", "run_id"], ["status", "run_id"]))
    assert got == [("a.csv", "I", 2), ("b.csv", "A", 3), ("c.csv", "A", 0)]
    listing = spark.createDataFrame([("a.csv",), ("b.csv",), ("d.csv",)], "file_name string")
    assert rows(already_done(listing, ledger, "file_name", "status", "I")) == [("a.csv",)]
    assert rows(not_done(listing, ledger, "file_name", "status", "I")) == [("b.csv",), ("d.csv",)]


def test_partitioned_overwrite_replaces_only_given_partitions(spark):
    path = shared_path(spark, "tests", "publish")
    schema = "v long, m string, s int"
    first = spark.createDataFrame([(1, "2023-01", 1), (2, "2023-01", 2), (3, "2023-02", 1)], schema)
    write_partitioned(first, path, ["m", "s"])
    write_partitioned(spark.createDataFrame([(9, "2023-02", 1)], schema), path, ["m", "s"])
    back = read_partitioned(spark, path, spark.createDataFrame([], schema).schema)
    assert rows(back, "m", "s", "v") == [("2023-01", 1, 1), ("2023-01", 2, 2), ("2023-02", 1, 9)]
    assert dict(back.dtypes) == {"v": "bigint", "m": "string", "s": "int"}
    write_partitioned(spark.createDataFrame([(7, "2023-02", 1)], schema), path, ["m", "s"], mode="append")
    assert back.sparkSession.read.parquet(path).where(F.col("m") == "2023-02").count() == 2
