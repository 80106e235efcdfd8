"""Daily series, lags, moving statistics and the feature table for demand models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.functions.calendar import calendar_columns
from shelfwise.functions.measures import UNITS, fixed_mean, ratio, revenue, revenue_units, unit_sum, with_price_units

FEATURE_COLUMNS = (
    "day_of_week", "day_of_month", "month", "quarter", "year", "is_weekend",
    "prev_day_quantity", "prev_week_quantity", "prev_month_quantity",
    "rolling_3d_avg", "rolling_7d_avg", "rolling_30d_avg",
    "rolling_7d_std", "rolling_30d_std", "price", "avg_price_7d",
)
LAGS = {"prev_day_quantity": 1, "prev_week_quantity": 7, "prev_month_quantity": 30}
MOVING_MEANS = {"rolling_3d_avg": 3, "rolling_7d_avg": 7, "rolling_30d_avg": 30}
MOVING_DEVIATIONS = {"rolling_7d_std": 7, "rolling_30d_std": 30}
SERIES = ("product_id", "county")


def daily_series(sales: DataFrame, keys: Sequence[str] = SERIES, date: str = "date") -> DataFrame:
    """One row per series and day: total quantity, mean price and revenue.

    The sums are built before the shuffle, and afterwards a series has no more rows than
    there are days, whatever its share of the sales. That bounds every window below.
    """
    sales, back = with_price_units(sales)
    sums = sales.groupBy(*keys, date).agg(
        F.sum("quantity").alias("quantity"),
        unit_sum(sales, F.col(UNITS)).alias("price"),
        F.count(UNITS).alias("priced"),
        unit_sum(sales, revenue_units(), "quantity").alias("revenue"),
    )
    return sums.select(
        *keys,
        date,
        "quantity",
        fixed_mean(back(F.col("price")), F.col("priced")).alias("price"),
        back(F.col("revenue")).alias("revenue"),
    )


def _frame(keys: Sequence[str], date: str, size: int, by_days: bool):
    """The last ``size`` rows, or the last ``size`` days, of a series."""
    if by_days:
        return Window.partitionBy(*keys).orderBy(F.unix_date(date)).rangeBetween(1 - size, 0)
    return Window.partitionBy(*keys).orderBy(date).rowsBetween(1 - size, 0)


def lag_columns(value: str, keys: Sequence[str], date: str, lags: dict[str, int]) -> dict[str, Column]:
    """Earlier values, counted in rows: the row before is the last day with a sale."""
    order = Window.partitionBy(*keys).orderBy(date)
    return {name: F.lag(value, n).over(order) for name, n in lags.items()}


def moving_means(
    value: str, keys: Sequence[str], date: str, sizes: dict[str, int], by_days: bool = False
) -> dict[str, Column]:
    means = {}
    for name, size in sizes.items():
        frame = _frame(keys, date, size, by_days)
        means[name] = ratio(F.sum(value).over(frame), F.count(value).over(frame))
    return means


def moving_deviations(
    value: str, keys: Sequence[str], date: str, sizes: dict[str, int], by_days: bool = False
) -> dict[str, Column]:
    """Sample standard deviations; null over a single row."""
    return {
        name: F.stddev_samp(value).over(_frame(keys, date, size, by_days)) for name, size in sizes.items()
    }


def sales_features(
    daily: DataFrame, keys: Sequence[str] = SERIES, date: str = "date", by_days: bool = False
) -> DataFrame:
    """The daily rows with calendar, lag and moving columns.

    Rows without a revenue get quantity times price. Missing lags and deviations become 0. All windows share one partitioning and order, so
    they take one shuffle and one sort. ``by_days`` counts the moving frames in calendar
    days instead of rows.
    """
    windows = {
        **lag_columns("quantity", keys, date, LAGS),
        **moving_means("quantity", keys, date, MOVING_MEANS, by_days),
        **moving_deviations("quantity", keys, date, MOVING_DEVIATIONS, by_days),
        **moving_means("price", keys, date, {"avg_price_7d": 7}, by_days),
    }
    day = F.col(date).cast("date")
    others = [c for c in daily.columns if c not in (date, "price", "revenue")]
    earned = F.col("revenue") if "revenue" in daily.columns else revenue()
    return daily.withColumn(date, day).select(
        *others,
        date,
        *[column.alias(name) for name, column in calendar_columns(F.col(date)).items()],
        *[F.coalesce(column, F.lit(0)).alias(name) for name, column in windows.items()],
        F.col("price").cast("double").alias("price"),
        earned.cast("double").alias("revenue"),
    )
