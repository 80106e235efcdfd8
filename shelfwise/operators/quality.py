"""Quality checks, issue counts and table profiles, each in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions.casting import is_blank, is_invalid_day

ROW_COUNT = "min_rows_check"
NEGATIVE_PRICES = "no_negative_prices_check"
NULL_PRODUCTS = "no_null_product_ids_check"
VALID_DATES = "valid_dates_check"


def _as_rows(totals: DataFrame, rows: list[dict[str, Column]]) -> DataFrame:
    """One row per item of ``rows`` from a frame of a single row."""
    structs = [F.struct(*[column.alias(name) for name, column in row.items()]) for row in rows]
    return totals.select(F.inline(F.array(*structs)))


def quality_checks(df: DataFrame, min_rows: int = 1000) -> DataFrame:
    """One row per check: name, passed, the number found, and the bound it is held against.

    The row count must be above ``min_rows``, the others must find nothing. The check on
    dates is made only if there is a ``date`` column.
    """
    found = {
        NEGATIVE_PRICES: F.col("price") < 0,
        NULL_PRODUCTS: is_blank("product_id"),
    }
    if "date" in df.columns:
        found[VALID_DATES] = is_invalid_day(df, "date")
    totals = df.agg(
        F.count(F.lit(1)).alias(ROW_COUNT),
        *[F.count_if(condition).alias(name) for name, condition in found.items()],
    )
    bound = F.lit(min_rows).cast("bigint")
    none = F.lit(0).cast("bigint")
    rows = [{"check": F.lit(ROW_COUNT), "passed": F.col(ROW_COUNT) > bound, "actual": F.col(ROW_COUNT),
             "threshold": bound}]
    rows += [
        {"check": F.lit(name), "passed": F.col(name) == 0, "actual": F.col(name), "threshold": none}
        for name in found
    ]
    return _as_rows(totals, rows)


def quality_verdict(checks: DataFrame) -> DataFrame:
    """One row: did every check pass."""
    passed = F.bool_and("passed")
    return checks.agg(
        passed.alias("passed"),
        F.when(passed, F.lit("PASSED")).otherwise(F.lit("FAILED")).alias("overall_status"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
    )


def quality_issues(curated: DataFrame) -> DataFrame:
    """Issue counts of a curated view: one scan for the three of them."""
    issues = {
        "Negative revenue": F.col("total_revenue") < 0,
        "Zero quantity": F.col("total_quantity") == 0,
        "Null product names": is_blank("product_name"),
    }
    totals = curated.agg(*[F.count_if(condition).alias(name) for name, condition in issues.items()])
    return _as_rows(totals, [{"issue_type": F.lit(name), "issue_count": F.col(f"`{name}`")} for name in issues])


def null_profile(df: DataFrame) -> DataFrame:
    """Rows and nulls of every column, from one aggregation."""
    totals = df.agg(
        F.count(F.lit(1)).alias("#rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    return _as_rows(
        totals,
        [{"column_name": F.lit(c), "total_records": F.col("`#rows`"), "null_count": F.col(f"`{c}`")}
         for c in df.columns],
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows; copies fold before the shuffle."""
    copies = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("#copies"))
    total = F.coalesce(F.sum("#copies"), F.lit(0))
    distinct = F.count(F.lit(1))
    return copies.agg(
        total.alias("total_records"), distinct.alias("distinct_records"), (total - distinct).alias("duplicate_count")
    )


