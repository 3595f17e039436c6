"""Adapter: the driver's TPC-H-like tables as the sales fact and dimensions.

Mapping (the same views the oracle SQL builds):

* sales      = lineitem ⋈ orders ⋈ supplier ⋈ part
* customer   = customer ⋈ nation (the audit of unmatched sales alone leaves out
               customers with a negative balance)
* store      = nation ⋈ region
* sales team = supplier ⋈ nation; the manager of a store is its lowest
               supplier key

Only the columns a view needs are selected, so every scan is pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.joins import join_dimension, maybe_broadcast
from salesmart.schemas import MONEY


# One DataFrame per table file and session: the file listing and footer read
# happen once, every query reuses the relation (the given tables are
# read-only).
_tables: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _tables:
        _tables[key] = spark.read.parquet(path)
    return _tables[key]


def _padded(c, width: int):
    return F.lpad(F.col(c).cast("string"), width, "0")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales fact with the SALES contract types plus two flag columns that
    stand in for unexpected CSV columns (``payment_mode``, ``channel``)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_shipdate", "l_returnflag", "l_linestatus",
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id")
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("store_id")
    )
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_retailprice"
    )
    # Orders first, while the rows are narrow: a product's name travels only
    # through the shuffle of its own join.
    f = join_dimension(li, orders, "l_orderkey").drop("l_orderkey")
    f = join_dimension(f, part, "l_partkey").drop("l_partkey")
    f = join_dimension(f, supplier, "l_suppkey")
    return f.select(
        "customer_id",
        "store_id",
        F.col("p_name").alias("product_name"),
        F.col("l_shipdate").cast("date").alias("sales_date"),
        F.col("l_suppkey").alias("sales_person_id"),
        F.col("p_retailprice").cast(MONEY).alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("total_cost"),
        F.col("l_returnflag").alias("payment_mode"),
        F.col("l_linestatus").alias("channel"),
    )


def customer_dim(spark: SparkSession, sf_dir: str, least_balance: float | None = None) -> DataFrame:
    """The customer dimension; ``least_balance`` leaves customers out, for the audit of unmatched sales."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    cust = table(spark, sf_dir, "customer")
    if least_balance is not None:
        cust = cust.where(F.col("c_acctbal") >= least_balance)
    cust = cust.select("c_custkey", "c_name", "c_nationkey")
    return join_dimension(cust, nation, "c_nationkey").select(
        F.col("c_custkey").alias("customer_id"),
        F.substring("c_name", 1, 8).alias("first_name"),
        F.expr("substring(c_name, 10)").alias("last_name"),
        F.col("n_name").alias("address"),
        _padded("c_nationkey", 6).alias("pincode"),
        F.concat(F.lit("91"), _padded("c_custkey", 8)).alias("phone_number"),
    )


def store_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return join_dimension(nation, region, "n_regionkey").select(
        F.col("n_nationkey").alias("id"),
        F.col("r_name").alias("address"),
        F.col("n_name").alias("store_manager_name"),
    )


def sales_team_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    sup = join_dimension(
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey"), nation, "s_nationkey"
    )
    # Manager per store = min key of the store's team: a partial/final
    # aggregate (one row per store), not a window over a whole store.
    managers = sup.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("manager_id"))
    return sup.join(maybe_broadcast(managers), "s_nationkey").select(
        F.col("s_suppkey").alias("id"),
        F.substring("s_name", 1, 8).alias("first_name"),
        F.expr("substring(s_name, 10)").alias("last_name"),
        "manager_id",
        F.when(F.col("s_suppkey") == F.col("manager_id"), "Y").otherwise("N").alias("is_manager"),
        F.col("n_name").alias("address"),
        _padded("s_nationkey", 6).alias("pincode"),
    )


def dimensions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return customer_dim(spark, sf_dir), store_dim(spark, sf_dir), sales_team_dim(spark, sf_dir)
