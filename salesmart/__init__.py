"""salesmart: a Spark-native retail sales mart builder.

Validated CSV drops are conformed to one typed fact schema, enriched with
customer / store / sales-team dimensions, published as (partitioned) Parquet
detail marts and rolled up into two monthly marts: purchases per customer and
sales per seller with an incentive for the top seller of each store-month.
A run ledger makes every file count once.
"""

__version__ = "0.1.0"
