"""Declared schemas: the contract every stage is typed against.

Types never depend on the data: CSV drops are read as strings and cast with
``try_cast`` to these types (money is decimal, not float).
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# The mandatory columns of a sales file, in contract order.
MANDATORY_COLUMNS = [
    "customer_id",
    "store_id",
    "product_name",
    "sales_date",
    "sales_person_id",
    "price",
    "quantity",
    "total_cost",
]

SALES = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("store_id", T.IntegerType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("sales_date", T.DateType()),
        T.StructField("sales_person_id", T.LongType()),
        T.StructField("price", MONEY),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("total_cost", MONEY),
        T.StructField("additional_column", T.StringType()),
    ]
)

# Columns of the dimensions.
CUSTOMER_DIM = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("pincode", T.StringType()),
        T.StructField("phone_number", T.StringType()),
    ]
)

STORE_DIM = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("address", T.StringType()),
        T.StructField("store_manager_name", T.StringType()),
    ]
)

SALES_TEAM_DIM = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("manager_id", T.LongType()),
        T.StructField("is_manager", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("pincode", T.StringType()),
    ]
)

# Columns of the enriched (star-joined) sales frame, in publish order.
ENRICHED_COLUMNS = [
    "customer_id",
    "first_name",
    "last_name",
    "address",
    "pincode",
    "phone_number",
    "store_id",
    "store_manager_name",
    "sales_person_id",
    "sales_person_first_name",
    "sales_person_last_name",
    "sales_person_address",
    "sales_person_pincode",
    "manager_id",
    "is_manager",
    "sales_date",
    "sales_month",
    "total_cost",
]

# Columns of the two detail marts.
CUSTOMER_MART_DETAIL = [
    "customer_id",
    "first_name",
    "last_name",
    "address",
    "pincode",
    "phone_number",
    "sales_date",
    "total_cost",
]

SELLER_MART_DETAIL = [
    "store_id",
    "sales_person_id",
    "sales_person_first_name",
    "sales_person_last_name",
    "store_manager_name",
    "manager_id",
    "is_manager",
    "sales_person_address",
    "sales_person_pincode",
    "sales_date",
    "total_cost",
    "sales_month",
]

# Run ledger: append-only; the latest row per file is its state.
# Status letters of the control table.
STATUS_STARTED = "A"
STATUS_DONE = "I"

# A file's version is its full location, length and modification time: a
# changed or re-delivered file is a new version.
VERSION = ["file_location", "length", "modification_time"]
_VERSION_FIELDS = [
    T.StructField("file_name", T.StringType()),
    T.StructField("file_location", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modification_time", T.TimestampType()),
]

# Columns of the control table, with the file's version.
LEDGER = T.StructType(
    [
        *_VERSION_FIELDS,
        T.StructField("status", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("run_id", T.LongType()),
    ]
)

REJECTS = T.StructType(
    [
        *_VERSION_FIELDS,
        T.StructField("reason", T.StringType()),
        T.StructField("missing_columns", T.ArrayType(T.StringType())),
        T.StructField("run_id", T.LongType()),
    ]
)
