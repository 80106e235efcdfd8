"""Measures: revenue, means and shares.

Sums of decimals are exact, so they do not depend on the order in which tasks finish
and a recomputed partition gives the same total. Means are one exact sum divided once.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

MEAN_SCALE = 8
MEAN_TYPE = f"decimal(38,{MEAN_SCALE})"


def revenue(price: str = "price", quantity: str = "quantity") -> Column:
    return F.col(price) * F.col(quantity)


UNITS = "_price_units"
# of a number of units, summed apart from the bits above them
LOW_BITS = 20


def with_price_units(df: DataFrame, price: str = "price") -> tuple[DataFrame, Callable[[Column], Column]]:
    """Add the price as a whole number of its smallest unit; also the way back from a sum.

    Whole numbers sum as fast as doubles and as exactly as decimals, whose wide sums leave
    the fast path of the aggregation. ``unit_sum`` totals them without overflow.
    Prices that are no decimals of up to 18 digits are taken as they are.
    """
    dtype = df.schema[price].dataType
    if not isinstance(dtype, T.DecimalType) or dtype.precision > 18:
        return df.withColumn(UNITS, F.col(price)), lambda total: total
    scale = dtype.scale
    units = (F.col(price) * F.lit(10**scale)).cast("bigint")

    def back(total: Column) -> Column:
        return (total.cast(f"decimal({max(20, 37 - scale)},0)") * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(30,{scale})")

    return df.withColumn(UNITS, units), back


def revenue_units(quantity: str = "quantity") -> Column:
    return F.col(UNITS) * F.col(quantity)


def unit_sum(df: DataFrame, value: Column, quantity: str | None = None) -> Column:
    """Aggregate: total of price units, or of units times ``quantity``, of ``df``.

    Of whole numbers the high and the low bits are summed apart in 64 bits and put together once a
    group, so that no number of rows found in practice (2 ** 43 of them) makes the total overflow.
    """
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    names = [UNITS, *([quantity] if quantity else [])]
    if not all(isinstance(df.schema[name].dataType, whole) for name in names):
        return F.sum(value)
    high, low = F.sum(F.shiftright(value, LOW_BITS)), F.sum(value.bitwiseAND((1 << LOW_BITS) - 1))
    return high.cast("decimal(20,0)") * F.lit(Decimal(1 << LOW_BITS)) + low.cast("decimal(20,0)")


def ratio(total: Column, count: Column) -> Column:
    """``total / count`` as a double, null where the count is zero."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def mean(value: str | Column) -> Column:
    """Aggregate: mean of the non-null values, from one sum and one count."""
    value = F.col(value) if isinstance(value, str) else value
    return ratio(F.sum(value), F.count(value))


def fixed_mean(total: Column, count: Column) -> Column:
    """A mean as a decimal with eight places, fit for exact summing later on."""
    return F.round(ratio(total, count), MEAN_SCALE).cast(MEAN_TYPE)


def mean_of_means(value: str | Column) -> Column:
    """Aggregate: unweighted mean of group means, summed as decimals of eight places."""
    value = F.col(value) if isinstance(value, str) else value
    return mean(F.round(value, MEAN_SCALE).cast(MEAN_TYPE))


def percentage(part: Column, whole: Column, places: int = 2) -> Column:
    return F.round(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), places)
