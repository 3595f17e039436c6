"""Column expressions shared by the marts.  All built-in, JVM-side."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.schemas import MONEY

# The incentive rate of a top seller, and the month format.
INCENTIVE_RATE = Decimal("0.01")
MONTH_FORMAT = "yyyy-MM"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_of(date_col: str | Column) -> Column:
    """``YYYY-MM`` of a date (the reference's ``substring(date, 1, 7)``)."""
    return F.date_format(col_(date_col), MONTH_FORMAT)


def full_name(first: str | Column, last: str | Column) -> Column:
    """``first || ' ' || last``; NULL when either part is NULL (``concat``)."""
    return F.concat(col_(first), F.lit(" "), col_(last))


def money(c: str | Column) -> Column:
    """Back to decimal(18,2): ``sum`` widens decimal precision by 10."""
    return col_(c).cast(MONEY)


def incentive(is_top: str | Column, total: str | Column) -> Column:
    """Top seller earns round(1 % of the month total, 2) (HALF_UP), others 0."""
    pay = F.round(col_(total) * F.lit(INCENTIVE_RATE), 2)
    return F.when(col_(is_top), pay).otherwise(F.lit(Decimal("0.00"))).cast(MONEY)


def quoted(name: str) -> str:
    """``name`` as one identifier, whatever dots or quotes it holds."""
    return "`" + name.replace("`", "``") + "`"


def fold_values(names: list[str]) -> Column:
    """Values of ``names`` joined by ',' in name order; NULLs are skipped.

    With no name at all the result is NULL (the reference's filler), with
    names whose values are all NULL it is ''.
    """
    if not names:
        return F.lit(None).cast("string")
    return F.concat_ws(",", *[F.col(quoted(n)).cast("string") for n in sorted(names)])


def variant_of(value: Column) -> Column:
    """A text as a VARIANT: what it reads as in JSON (numbers, booleans), else the string."""
    # only what begins like JSON is parsed: a text that fails costs an exception
    parsed = F.when(value.rlike(r'^\s*(-?[0-9]|[\[{"]|(true|false|null)\s*$)'), F.try_parse_json(value))
    return F.coalesce(parsed, value.cast("variant"))


def variant_long(value: str | Column) -> Column:
    """A VARIANT as a long, NULL where it does not cast."""
    value = col_(value)
    # a value that fails costs an exception: a string with a letter is no number, so it is not tried
    may_cast = (F.schema_of_variant(value) != "STRING") | ~value.cast("string").rlike("[A-Za-z]")
    return F.when(may_cast, F.try_variant_get(value, "$", "bigint"))


def fold_variant(names: list[str]) -> Column:
    """The columns ``names`` as one VARIANT object, values with the types they read as; NULL without any name."""
    if not names:
        return F.lit(None).cast("variant")
    return F.to_variant_object(F.struct(*[variant_of(F.col(quoted(n)).cast("string")).alias(n) for n in sorted(names)]))


def fold_json(names: list[str]) -> Column:
    """Lossless twin of :func:`fold_values`: ``{"name": value, ...}``."""
    if not names:
        return F.lit(None).cast("string")
    return F.to_json(F.struct(*[F.col(quoted(n)).cast("string").alias(n) for n in sorted(names)]))
