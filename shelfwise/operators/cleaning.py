"""Cleaning of raw sales and products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions.casting import or_default, to_day, to_number

UNKNOWN = "Unknown"


def _numbers(df: DataFrame, price_type: str) -> dict[str, Column]:
    return {
        "quantity": to_number(or_default(df, "quantity", 0), "int"),
        "price": to_number(or_default(df, "price", 0.0), price_type),
    }


def is_kept(df: DataFrame, price_type: str = "float") -> Column:
    """Whether ``clean_sales`` keeps a raw row; never null."""
    numbers = _numbers(df, price_type)
    return F.coalesce((numbers["price"] >= 0) & (numbers["quantity"] >= 0), F.lit(False))


def clean_sales(df: DataFrame, price_type: str = "float", drop_nan: bool = False) -> DataFrame:
    """Missing price and quantity become 0; malformed or negative ones drop the row.

    The text 'NaN' is a number and not below zero, so it stays unless ``drop_nan``.
    A ``date`` column is made a date, null when malformed.
    """
    columns = {"product_id": F.col("product_id").cast("string"), **_numbers(df, price_type)}
    if "date" in df.columns:
        columns["date"] = to_day(F.col("date"))
    cleaned = df.withColumns(columns).filter((F.col("price") >= 0) & (F.col("quantity") >= 0))
    if drop_nan and price_type in ("float", "double"):
        cleaned = cleaned.filter(~F.isnan("price"))
    return cleaned


def clean_products(df: DataFrame) -> DataFrame:
    """Missing names and categories become 'Unknown'; the id is text."""
    return df.fillna({"product_name": UNKNOWN, "category": UNKNOWN}).withColumn(
        "product_id", F.col("product_id").cast("string")
    )
