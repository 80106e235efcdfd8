"""Demand trend and stock levels per county, for all counties in one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions.calendar import latest_day
from shelfwise.functions.measures import mean, ratio
from shelfwise.operators.joins import with_future_days

Z_95_PERCENT = 1.65
EXACT = "decimal(38,0)"


def fit_trends(daily: DataFrame, keys: Sequence[str] = ("county",), date: str = "date",
               value: str = "quantity") -> DataFrame:
    """Least-squares line of the daily value over the day number, one row per group.

    Only sums are needed, so a group of any size is fitted by partial sums; those of whole
    numbers are exact. A group with a single day gets a flat line.
    """
    x = F.unix_date(date).cast("bigint")
    y = F.col(value).cast("bigint")
    usable = daily.filter(F.col(date).isNotNull() & F.col(value).isNotNull())
    sums = usable.groupBy(*keys).agg(
        F.count(F.lit(1)).cast(EXACT).alias("n"),
        F.sum(x).cast(EXACT).alias("sx"),
        F.sum(y).cast(EXACT).alias("sy"),
        F.sum((x * y).cast("decimal(28,0)")).cast(EXACT).alias("sxy"),
        F.sum((x * x).cast("decimal(28,0)")).cast(EXACT).alias("sxx"),
    )
    slope = F.expr("try_divide(cast(n * sxy - sx * sy as double), cast(n * sxx - sx * sx as double))")
    return sums.withColumn("slope", F.coalesce(slope, F.lit(0.0))).select(
        *keys,
        F.expr("(cast(sy as double) - slope * cast(sx as double)) / cast(n as double)").alias("intercept"),
        "slope",
        F.col("n").cast("bigint").alias("days_observed"),
    )


def forecast_trends(daily: DataFrame, days: int = 30, keys: Sequence[str] = ("county",), date: str = "date",
                    value: str = "quantity", last_day: Column | None = None) -> DataFrame:
    """Each group's line over the ``days`` days after ``last_day``, by default that of the table."""
    trends = fit_trends(daily, keys, date, value)
    last_day = latest_day(daily, date) if last_day is None else last_day
    future = with_future_days(trends, last_day, days, date)
    prediction = F.col("intercept") + F.col("slope") * F.unix_date(date)
    return future.select(*keys, date, prediction.alias("prediction"))


def stock_levels(
    forecasts: DataFrame,
    keys: Sequence[str] = ("county",),
    value: str = "prediction",
    lead_time_days: int = 7,
    order_cost: float = 50.0,
    holding_cost: float = 2.0,
    days_per_year: int = 365,
) -> DataFrame:
    """Mean demand, safety stock, reorder point and economic order quantity per group.

    The order quantity is sqrt(2 D S / H) with yearly demand D, cost S of an order and cost
    H of holding a unit for a year.
    """
    levels = forecasts.groupBy(*keys).agg(
        mean(value).alias("avg_daily_demand"),
        (F.stddev_samp(value) * Z_95_PERCENT).alias("safety_stock"),
    )
    yearly = F.greatest(F.col("avg_daily_demand") * days_per_year, F.lit(0.0))
    return levels.select(
        *keys,
        "avg_daily_demand",
        "safety_stock",
        (F.col("avg_daily_demand") * lead_time_days + F.col("safety_stock")).alias("reorder_point"),
        F.sqrt(ratio(yearly * (2 * order_cost), F.lit(holding_cost))).alias("economic_order_quantity"),
    )
