"""Top rows of a table and of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.operators.curated import county_product_sales


def top_rows(df: DataFrame, n: int, by: str, tie_break: Sequence[str]) -> DataFrame:
    """The ``n`` rows with the largest ``by``; each task keeps ``n`` rows at most."""
    return df.orderBy(F.desc(by), *[F.asc(c) for c in tie_break]).limit(n)


def _within(groups: Sequence[str], order: Sequence[Column]):
    return Window.partitionBy(*groups).orderBy(*order)


def rank_within(df: DataFrame, groups: Sequence[str], by: str, name: str, limit: int | None = None) -> DataFrame:
    """Rank by ``by`` descending in each group, ties sharing a rank.

    With a limit Spark drops what cannot rank before the shuffle, so a group with a third
    of the rows sends only its leaders to the task that ranks it.
    """
    ranked = df.withColumn(name, F.rank().over(_within(groups, [F.desc(by)])))
    return ranked if limit is None else ranked.filter(F.col(name) <= limit)


def number_within(
    df: DataFrame, groups: Sequence[str], by: str, tie_break: Sequence[str], name: str, limit: int | None = None
) -> DataFrame:
    """Row number by ``by`` descending in each group, ties in the order of ``tie_break``."""
    order = [F.desc(by), *[F.asc(c) for c in tie_break]]
    numbered = df.withColumn(name, F.row_number().over(_within(groups, order)))
    return numbered if limit is None else numbered.filter(F.col(name) <= limit)


def top_items_per_county(
    sales: DataFrame, products: DataFrame | None = None, k: int = 10, ordered: bool = True,
    money: str | None = "double",
) -> DataFrame:
    """The products of rank ``k`` or better by revenue in each county; ties may give more."""
    return rank_items(county_product_sales(sales, products, money=None), k, ordered, money)


def rank_items(
    items: DataFrame, k: int = 10, ordered: bool = True, money: str | None = "double"
) -> DataFrame:
    """As ``top_items_per_county``, from totals by county and product."""
    top = rank_within(items, ["county"], "total_revenue", "revenue_rank", k)
    if money:
        top = top.withColumn("total_revenue", F.col("total_revenue").cast(money))
    return top.orderBy("county", "revenue_rank", "product_id") if ordered else top
