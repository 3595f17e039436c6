"""Sales generated from counters: row ``i`` is the same under any partitioning.

A value is an integer mix of the row's number, the seed and the column's
number: no generator state, nothing that depends on tasks.  Keys are drawn
from given dimension tables by the place of a key in their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.config import shared_path
from salesmart.operators.joins import fits_broadcast, join_dimension
from salesmart.schemas import MONEY

#: Modulus and multipliers; every product stays below 2^63.
PRIME, A, B, C, D = 2_147_483_647, 48_271, 69_621, 16_807, 40_692

#: Rows of a task of a join whose dimension is too large to broadcast, about; the first key's rows are dealt into parts of this size.
TASK_ROWS = 1 << 19


def mixed(row: Column, seed: int, stream: int) -> Column:
    """A number from 0 to PRIME - 1 for the row, the seed and the stream (one for each column)."""
    a = (row % PRIME * A + (seed * B + stream * D + 1)) % PRIME
    b = (a * C + (stream * B + 12_345)) % PRIME
    return (b * B + a) % PRIME


def placed(df: DataFrame, key: str) -> DataFrame:
    """``df`` with ``place``, the number of smaller keys (keys are unique).

    Range partitions number their own rows; the rows of the partitions before
    are one small count each.
    """
    spark = df.sparkSession
    path = shared_path(spark, "placed")
    df.orderBy(key).withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumns({"_part": F.shiftright("_id", 33), "_row": F.col("_id").bitwiseAND((1 << 33) - 1)})
    counts = sorted((r["_part"], r["n"]) for r in rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    ahead, offsets = 0, []
    for part, n in counts:
        offsets.append((part, ahead))
        ahead += n
    offset = F.broadcast(spark.createDataFrame(offsets, "_part long, _ahead long"))
    return rows.join(offset, "_part").withColumn("place", F.col("_ahead") + F.col("_row")).drop("_id", "_part", "_row", "_ahead")


def _join_placed(base: DataFrame, side: DataFrame, place: str, rows: int, hot_permille: int) -> DataFrame:
    """``base`` and the dimension row of its ``place``.  Where both are shuffled, tasks follow the rows, and the rows
    of the first key are dealt into parts, each with a copy of that key's one row.  The join is a
    merge join: a hash table of the dimension, as of its compressed size, would grow with it."""
    if fits_broadcast(side):
        return join_dimension(base, side, place)
    parts = -(-rows * hot_permille // 1000 // TASK_ROWS) or 1
    tasks = max(int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))
    dealt = base.withColumn("_deal", F.when(F.col(place) == 0, F.col("row_id") % parts).otherwise(0))
    copies = F.when(F.col(place) == 0, F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    side = side.withColumn("_deal", F.explode(copies))
    return dealt.repartition(tasks, place, "_deal").join(side.hint("merge"), [place, "_deal"]).drop("_deal")


def counted_sales(
    spark: SparkSession, rows: int, seed: int, customer: DataFrame, team: DataFrame, product: DataFrame, hot_permille: int = 0, partitions: int | None = None, first_day: str = "2023-01-01", days: int = 365
) -> DataFrame:
    """``rows`` sales with the mandatory columns and ``row_id``.

    ``customer``: ``customer_id``; ``team``: ``id, store_id``; ``product``:
    ``product_id, product_name, price``.  ``hot_permille`` of the rows belong
    to the first customer and the first seller.
    """
    sizes = [df.count() for df in (customer, team, product)]
    row = F.col("row_id")
    hot = mixed(row, seed, 0) % 1000 < hot_permille
    draw = lambda stream, n: mixed(row, seed, stream) % max(n, 1)
    base = spark.range(0, rows, 1, partitions) if partitions else spark.range(rows)
    base = base.select(
        F.col("id").alias("row_id")
    ).select(
        "row_id",
        F.when(hot, 0).otherwise(draw(1, sizes[0])).alias("c_place"),
        F.when(hot, 0).otherwise(draw(2, sizes[1])).alias("t_place"),
        draw(3, sizes[2]).alias("p_place"),
        F.date_add(F.lit(first_day).cast("date"), draw(4, days).cast("int")).alias("sales_date"),
        (draw(5, 10) + 1).cast("int").alias("quantity"),
    )
    sides = (
        (placed(customer.select("customer_id"), "customer_id"), "c_place"),
        (placed(team.select(F.col("id").alias("sales_person_id"), "store_id"), "sales_person_id"), "t_place"),
        (placed(product.select("product_id", "product_name", "price"), "product_id"), "p_place"),
    )
    for side, place in sides:
        base = _join_placed(base, side.withColumnRenamed("place", place), place, rows, hot_permille if place != "p_place" else 0)
    return base.select(
        "row_id", "customer_id", "store_id", "product_name", "sales_date", "sales_person_id", F.col("price").cast(MONEY).alias("price"), "quantity",
        (F.col("price") * F.col("quantity")).cast(MONEY).alias("total_cost"),
    )
