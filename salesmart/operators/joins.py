"""Dimension joins with a proven broadcast bound.

A side is broadcast only when a count of its rows and bytes, summed up on the
executors, has shown that it holds at most ``salesmart.broadcast.maxRows`` rows
and ``salesmart.broadcast.maxBytes`` bytes.  Beyond the bound the join is a
plain shuffle join, left to AQE (skew splitting, runtime broadcast from
measured sizes).
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart import config

_FIXED_WIDTH = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.DateType: 4,
    T.FloatType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
    T.DecimalType: 16,
}

# Decisions per (application, plan, bounds), kept for a while so a query
# does not re-probe the same dimension; a long-running stream re-probes
# after the TTL because a dimension may grow.
_decisions: dict[tuple, tuple[float, bool]] = {}


def _field_bytes(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    for typ, width in _FIXED_WIDTH.items():
        if isinstance(field.dataType, typ):
            return F.lit(width)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(8)
    return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + F.lit(8)


def fits_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """True when ``df`` is proven to be within the broadcast bound."""
    spark = df.sparkSession
    max_rows = max_rows if max_rows is not None else config.conf_int(spark, config.BROADCAST_MAX_ROWS)
    max_bytes = max_bytes if max_bytes is not None else config.conf_int(spark, config.BROADCAST_MAX_BYTES)
    key = (spark.sparkContext.applicationId, df.semanticHash(), max_rows, max_bytes)
    ttl = config.conf_int(spark, config.BROADCAST_PROBE_TTL)
    hit = _decisions.get(key)
    if hit is not None and time.monotonic() - hit[0] < ttl:
        return hit[1]
    row_bytes = sum((_field_bytes(f) for f in df.schema.fields), F.lit(0))
    # One partial/final aggregate over the pruned side: a single row comes back,
    # and a side too large costs one scan of it, far less than its join.
    n, size = df.select(row_bytes.alias("b")).agg(F.count(F.lit(1)), F.coalesce(F.sum("b"), F.lit(0))).first()
    ok = n <= max_rows and size <= max_bytes
    now = time.monotonic()
    for old in [k for k, (at, _) in _decisions.items() if now - at >= ttl]:
        del _decisions[old]
    _decisions[key] = (now, ok)
    return ok


def maybe_broadcast(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """``fact ⋈ dim``: broadcast hash join when ``dim`` is proven small."""
    return fact.join(maybe_broadcast(dim), on, how)
