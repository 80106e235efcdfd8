"""Casts and null handling that never fail on malformed input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

FLOATING = ("float", "double")


def or_default(df: DataFrame, name: str, default) -> Column:
    """The column with null, and NaN where the type has one, replaced by ``default``."""
    missing = F.col(name).isNull()
    dtype = dict(df.dtypes)[name]
    if dtype in FLOATING:
        missing = missing | F.isnan(name)
    value = F.lit(str(default)) if dtype == "string" else F.lit(default)
    return F.when(missing, value).otherwise(F.col(name))


def to_number(value: Column, type_name: str) -> Column:
    """Null when malformed. Text such as '3.7' becomes 3 as an integer."""
    number = value.try_cast(type_name)
    if type_name in ("int", "bigint"):
        number = F.coalesce(number, value.try_cast("decimal(38,10)").try_cast(type_name))
    return number


def to_day(value: Column) -> Column:
    """A date, null when malformed."""
    return value.try_cast("date")


def is_blank(name: str) -> Column:
    """Null or the empty string."""
    return F.col(name).isNull() | (F.col(name) == "")


def is_invalid_day(df: DataFrame, name: str) -> Column:
    """Null, or text that is no date."""
    if dict(df.dtypes)[name] == "string":
        return to_day(F.col(name)).isNull()
    return F.col(name).isNull()
