"""Seeded sales-file generators and dimension fixtures (for tests and demos).

Rows are made by Spark (``range`` + seeded ``rand``), never by a driver loop.
Domains follow the reference's generators: 20 of 25 customers buy, three of
four stores sell, three sellers per store (seller 10 is the manager and never
sells), eight products, quantity 1-10, total = price x quantity.  Names,
addresses and products are our own inventions.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.schemas import CUSTOMER_DIM, MANDATORY_COLUMNS, SALES_TEAM_DIM, STORE_DIM

# Fixed values (invented): products and their prices.
PRODUCTS = [
    ("oat flakes", "1.50"),
    ("green tea", "4.25"),
    ("olive oil", "9.80"),
    ("basmati rice", "12.40"),
    ("coffee beans", "18.00"),
    ("desk lamp", "35.99"),
    ("rice cooker", "89.00"),
    ("espresso maker", "212.00"),
]
STORES = [121, 122, 123]
SELLERS_PER_STORE = 3


def sales_frame(
    spark: SparkSession,
    rows: int,
    seed: int,
    start: dt.date = dt.date(2023, 3, 3),
    end: dt.date = dt.date(2023, 8, 20),
    hot_share: float = 0.0,
) -> DataFrame:
    """``rows`` sales lines with the eight mandatory columns as strings.

    With ``hot_share`` > 0 that share of the rows belongs to customer 1 and
    seller 1 (store 121), the skew the marts must survive.
    """
    days = (end - start).days + 1
    names = F.array(*[F.lit(n) for n, _ in PRODUCTS])
    prices = F.array(*[F.lit(Decimal(p)) for _, p in PRODUCTS])
    hot = F.rand(seed + 7) < F.lit(hot_share)
    seller = F.when(hot, F.lit(1)).otherwise(
        (F.floor(F.rand(seed + 1) * (len(STORES) * SELLERS_PER_STORE)) + 1).cast("int")
    )
    customer = F.when(hot, F.lit(1)).otherwise((F.floor(F.rand(seed) * 20) + 1).cast("int"))
    product = (F.floor(F.rand(seed + 2) * len(PRODUCTS)) + 1).cast("int")
    quantity = (F.floor(F.rand(seed + 4) * 10) + 1).cast("int")
    df = spark.range(rows).select(
        customer.alias("customer_id"),
        (F.lit(STORES[0]) + F.floor((seller - 1) / SELLERS_PER_STORE)).cast("int").alias("store_id"),
        F.element_at(names, product).alias("product_name"),
        F.date_add(F.lit(start), F.floor(F.rand(seed + 3) * days).cast("int")).alias("sales_date"),
        seller.alias("sales_person_id"),
        F.element_at(prices, product).alias("price"),
        quantity.alias("quantity"),
    ).withColumn("total_cost", (F.col("price") * F.col("quantity")).cast("decimal(18,2)"))
    return df.select(*[F.col(c).cast("string") for c in MANDATORY_COLUMNS])


def write_csv(df: DataFrame, path: str, files: int = 1) -> None:
    df.coalesce(files).write.mode("overwrite").option("header", True).csv(path)


def multi_day_file(spark, path, rows=500_000, seed=1):
    write_csv(sales_frame(spark, rows, seed), path)


def one_day_file(spark, path, rows=400_000, seed=2, day=dt.date(2023, 8, 21)):
    write_csv(sales_frame(spark, rows, seed, day, day), path)


def extra_column_file(spark, path, rows=1_000, seed=3):
    modes = F.array(F.lit("cash"), F.lit("UPI"), F.lit("card"))
    df = sales_frame(spark, rows, seed).withColumn(
        "payment_mode", F.element_at(modes, (F.floor(F.rand(seed + 9) * 3) + 1).cast("int"))
    )
    write_csv(df, path)


def missing_column_file(spark, path, rows=200, seed=4):
    df = sales_frame(spark, rows, seed).drop("store_id").withColumn("payment_mode", F.lit("cash"))
    write_csv(df, path)


def customer_dim(spark: SparkSession, n: int = 25) -> DataFrame:
    firsts = F.array(*[F.lit(x) for x in ["Asha", "Ravi", "Meera", "Kabir", "Tara"]])
    lasts = F.array(*[F.lit(x) for x in ["Rao", "Iyer", "Khan", "Das", "Paul"]])
    df = spark.range(1, n + 1).select(
        F.col("id").alias("customer_id"),
        F.element_at(firsts, (F.col("id") % 5 + 1).cast("int")).alias("first_name"),
        F.element_at(lasts, (F.floor(F.col("id") / 5) % 5 + 1).cast("int")).alias("last_name"),
        F.concat(F.lit("Street "), F.col("id").cast("string")).alias("address"),
        F.lpad(F.col("id").cast("string"), 6, "4").alias("pincode"),
        F.concat(F.lit("98"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("phone_number"),
    )
    return df.select(*[F.col(f.name).cast(f.dataType) for f in CUSTOMER_DIM.fields])


def product_dim(spark: SparkSession) -> DataFrame:
    """The products that the generated sales name, with their prices."""
    rows = [(k, name, Decimal(price)) for k, (name, price) in enumerate(PRODUCTS, 1)]
    return spark.createDataFrame(rows, "id int, name string, current_price decimal(18,2)")


def store_dim(spark: SparkSession) -> DataFrame:
    df = spark.range(121, 125).select(
        F.col("id").cast("int").alias("id"),
        F.concat(F.lit("Market road "), F.col("id").cast("string")).alias("address"),
        F.concat(F.lit("Manager "), F.col("id").cast("string")).alias("store_manager_name"),
    )
    return df.select(*[F.col(f.name).cast(f.dataType) for f in STORE_DIM.fields])


def sales_team_dim(spark: SparkSession, n: int = 10) -> DataFrame:
    df = spark.range(1, n + 1).select(
        F.col("id"),
        F.concat(F.lit("Seller"), F.col("id").cast("string")).alias("first_name"),
        F.concat(F.lit("Team"), F.col("id").cast("string")).alias("last_name"),
        F.lit(n).cast("long").alias("manager_id"),
        F.when(F.col("id") == n, "Y").otherwise("N").alias("is_manager"),
        F.concat(F.lit("Lane "), F.col("id").cast("string")).alias("address"),
        F.lpad(F.col("id").cast("string"), 6, "5").alias("pincode"),
    )
    return df.select(*[F.col(f.name).cast(f.dataType) for f in SALES_TEAM_DIM.fields])
