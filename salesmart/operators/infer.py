"""Column types found from the values of a drop.

Every value has a mask of the types that can hold it; types widen along
int, bigint, double and along date, timestamp, and any value is a string.  The
types of a column are the bits that all of its values share: ``bit_and`` is a
mergeable aggregate, so a column is inferred in parts of a file, over files
and over drops alike, and masks can be stored and merged with later ones.
Empty values say nothing; a column without any other is ``void``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.sources.files import fields_of

#: Types from the narrowest on; bit k of a mask is type k.
TYPES = ("boolean", "int", "bigint", "double", "date", "timestamp")
_BIT = {name: 1 << k for k, name in enumerate(TYPES)}
EVERY = (1 << len(TYPES)) - 1

_INTEGER = r"^[+-]?[0-9]{1,19}$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?$"


def mask_of(value: Column) -> Column:
    """The types that hold ``value`` as bits; all of them for NULL."""
    fits = lambda kind: value.try_cast(kind).isNotNull()
    integer = value.rlike(_INTEGER)
    return (
        F.when(value.isNull(), EVERY)
        .when(integer & fits("int"), _BIT["int"] | _BIT["bigint"] | _BIT["double"])
        .when(integer & fits("bigint"), _BIT["bigint"] | _BIT["double"])
        .when(value.rlike(_NUMBER), _BIT["double"])
        .when(value.rlike(_DATE) & fits("date"), _BIT["date"] | _BIT["timestamp"])
        .when(value.rlike(_TIMESTAMP) & fits("timestamp"), _BIT["timestamp"])
        .when(F.lower(value).isin("true", "false"), _BIT["boolean"])
        .otherwise(0)
    )


def type_of(mask: Column, n: Column) -> Column:
    """The narrowest type of a mask of ``n`` values."""
    found = F.when(n == 0, "void")
    for name in TYPES:
        found = found.when(mask.bitwiseAND(_BIT[name]) != 0, name)
    return found.otherwise("string")


def column_masks(lines: DataFrame, by: str = "file_location") -> DataFrame:
    """``by, column, mask, n, n_empty`` of data lines with their file's ``columns``."""
    fields = lines.select(by, "columns", F.posexplode(fields_of(F.col("value"))).alias("at", "field"))
    named = fields.select(by, F.get("columns", F.col("at")).alias("column"), mask_of(F.col("field")).alias("mask"), F.col("field").isNotNull().cast("long").alias("has"))
    return named.where(F.col("column").isNotNull()).groupBy(by, "column").agg(F.bit_and("mask").alias("mask"), F.sum("has").alias("n"), F.sum(1 - F.col("has")).alias("n_empty"))


def merge_masks(masks: DataFrame, by: list[str]) -> DataFrame:
    """Masks of larger groups from those of smaller ones."""
    return masks.groupBy(*by).agg(F.bit_and("mask").alias("mask"), F.sum("n").alias("n"), F.sum("n_empty").alias("n_empty"))


def inferred_types(masks: DataFrame, by: str = "file_location") -> DataFrame:
    """``by, column, type, widened, drift``: the type in each group, over all groups, and whether they differ."""
    all_groups = merge_masks(masks, ["column"]).select("column", type_of(F.col("mask"), F.col("n")).alias("widened"))
    own = masks.select(by, "column", type_of(F.col("mask"), F.col("n")).alias("type"))
    # one row per column name on the right
    return own.join(all_groups, "column").select(by, "column", "type", "widened", ((F.col("type") != F.col("widened")) & (F.col("type") != "void")).alias("drift"))
