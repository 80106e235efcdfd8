"""Calendar columns and relative dates."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F

# Spark numbers the days of the week from Sunday = 1 to Saturday = 7.
WEEKEND_DAYS = (1, 7)


def is_weekend(day: Column) -> Column:
    return F.when(F.dayofweek(day).isin(*WEEKEND_DAYS), F.lit(1)).otherwise(F.lit(0))


def calendar_columns(day: Column) -> dict[str, Column]:
    return {
        "day_of_week": F.dayofweek(day),
        "day_of_month": F.dayofmonth(day),
        "month": F.month(day),
        "quarter": F.quarter(day),
        "year": F.year(day),
        "is_weekend": is_weekend(day),
    }


def as_day(as_of: Column | datetime.date | str | None) -> Column:
    """``as_of`` as a date column; today if none is given."""
    if as_of is None:
        return F.current_date()
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("date")


def within_last_months(day: Column, months: int, as_of=None) -> Column:
    return day >= F.add_months(as_day(as_of), -months)


def latest_day(df: DataFrame, date: str = "date") -> Column:
    """The largest date of ``df`` as a scalar subquery: lazy, and run once per query."""
    return df.agg(F.max(date)).scalar()
