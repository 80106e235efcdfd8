"""Business reports over the curated tables and the refined sales.

``view`` is the comprehensive view, ``by_product`` and ``by_county`` the tables of that name.
Totals may be decimals (exact) or doubles; every report gives doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.functions.calendar import as_day, within_last_months
from shelfwise.functions.measures import mean_of_means, percentage, revenue_units, unit_sum, with_price_units
from shelfwise.operators.joins import join_known_products
from shelfwise.operators.quality import quality_issues  # noqa: F401  (the thirteenth report)
from shelfwise.operators.ranking import number_within, top_rows


def _money(name: str = "total_revenue"):
    return F.sum(name).cast("double").alias(name)


def _units():
    return F.sum("total_quantity").alias("total_quantity")


def top_counties(view: DataFrame, n: int = 10) -> DataFrame:
    """Counties by revenue, with the number of product rows."""
    totals = view.groupBy("county").agg(_money(), _units(), F.count(F.lit(1)).alias("product_count"))
    return top_rows(totals, n, "total_revenue", ["county"])


def top_categories(view: DataFrame, n: int = 10) -> DataFrame:
    """Categories by revenue, with the counties served and the mean of mean prices."""
    totals = view.groupBy("category").agg(
        _money(), _units(),
        F.count_distinct("county").alias("counties_served"),
        mean_of_means("avg_price").alias("avg_category_price"),
    )
    return top_rows(totals, n, "total_revenue", ["category"])


def top_products(by_product: DataFrame, n: int = 10) -> DataFrame:
    """Products by revenue."""
    totals = by_product.groupBy("product_id", "product_name", "category").agg(
        _money(), _units(), F.sum("transaction_count").alias("total_transactions")
    )
    return top_rows(totals, n, "total_revenue", ["product_id", "product_name", "category"])


def top_county_categories(view: DataFrame, n: int = 10) -> DataFrame:
    """Pairs of county and category by revenue, with the number of different products."""
    totals = view.groupBy("county", "category").agg(
        _money(), _units(), F.count_distinct("product_id").alias("unique_products")
    )
    return top_rows(totals, n, "total_revenue", ["county", "category"])


def revenue_share(view: DataFrame) -> DataFrame:
    """Revenue by county and category, and its percentage of the county.

    The window is over totals: a county has one row per category in it.
    """
    totals = view.groupBy("county", "category").agg(F.sum("total_revenue").alias("total_revenue"), _units())
    county_total = F.sum("total_revenue").over(Window.partitionBy("county"))
    return totals.select(
        "county",
        "category",
        F.col("total_revenue").cast("double").alias("total_revenue"),
        "total_quantity",
        percentage(F.col("total_revenue"), county_total).alias("revenue_percentage_by_county"),
    ).orderBy(F.asc("county"), F.desc("total_revenue"))


def transaction_value(by_county: DataFrame) -> DataFrame:
    """Mean revenue of a sale by county. The count is of table rows: one per county."""
    return (
        by_county.groupBy("county")
        .agg(
            F.avg("avg_transaction_value").alias("avg_transaction_value"),
            _money(),
            F.count(F.lit(1)).alias("transaction_count"),
        )
        .orderBy(F.desc("avg_transaction_value"))
    )


def top_products_per_county(top_items: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` best products of each county, numbered without ties."""
    numbered = number_within(
        top_items, ["county"], "total_revenue", ["product_id", "product_name", "category"], "rank_in_county", k
    )
    return numbered.select(
        "county", "product_id", "product_name", "category",
        F.col("total_revenue").cast("double").alias("total_revenue"), "rank_in_county",
    ).orderBy("county", "rank_in_county")


def category_performance(view: DataFrame) -> DataFrame:
    """Totals by category, with different counties and products and the mean of mean prices."""
    return (
        view.groupBy("category")
        .agg(
            F.count_distinct("county").alias("counties_available"),
            _money(), _units(),
            mean_of_means("avg_price").alias("avg_price"),
            F.count_distinct("product_id").alias("unique_products"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def price_range(by_product: DataFrame) -> DataFrame:
    """Lowest, mean and highest price by category, and the spread."""
    low, high = F.min("min_price"), F.max("max_price")
    return (
        by_product.groupBy("category")
        .agg(
            low.cast("double").alias("lowest_price"),
            mean_of_means("avg_price").alias("avg_price"),
            high.cast("double").alias("highest_price"),
            (high - low).cast("double").alias("price_range"),
        )
        .orderBy(F.desc("avg_price"))
    )


def market_penetration(view: DataFrame) -> DataFrame:
    """Different categories and products by county, with totals."""
    return (
        view.groupBy("county")
        .agg(
            F.count_distinct("category").alias("categories_served"),
            F.count_distinct("product_id").alias("unique_products_offered"),
            _money(), _units(),
        )
        .orderBy(F.desc("categories_served"), F.desc("total_revenue"))
    )


def monthly_revenue(sales: DataFrame, months: int = 6, as_of=None) -> DataFrame:
    """Revenue and units by month and county over the last ``months`` months before ``as_of``."""
    recent, back = with_price_units(sales.filter(within_last_months(F.col("date"), months, as_of)))
    return (
        recent.groupBy(F.trunc("date", "MM").alias("month"), "county")
        .agg(
            back(unit_sum(recent, revenue_units(), "quantity")).cast("double").alias("monthly_revenue"),
            F.sum("quantity").alias("monthly_quantity"),
        )
        .orderBy(F.desc("month"), F.desc("monthly_revenue"))
    )


def county_drill_down(view: DataFrame, county: str, n: int = 100) -> DataFrame:
    """The ``n`` rows of one county with the largest revenue."""
    rows = view.filter(F.col("county") == county)
    top = top_rows(rows, n, "total_revenue", ["product_id", "category"])
    return top.select(
        "product_name", "category", F.col("total_revenue").cast("double").alias("total_revenue"), "total_quantity"
    )


def county_sales(sales: DataFrame) -> DataFrame:
    """Number of sales and revenue by county."""
    sales, back = with_price_units(sales)
    total = back(unit_sum(sales, revenue_units(), "quantity")).cast("double")
    return (
        sales.groupBy("county")
        .agg(F.count(F.lit(1)).alias("sales_count"), total.alias("total_revenue"))
        .orderBy(F.desc("total_revenue"))
    )


def county_sales_with_names(sales: DataFrame, products: DataFrame, county: str) -> DataFrame:
    """The sales of one county whose product is known, with its name."""
    joined = join_known_products(sales, products, F.col("county") == county)
    return joined.select("product_id", "product_name", "county", "quantity")


def county_units_since(sales: DataFrame, since) -> DataFrame:
    """Units by county from a date on."""
    return (
        sales.filter(F.col("date") >= as_day(since))
        .groupBy("county")
        .agg(F.sum("quantity").alias("total_sales"))
        .orderBy(F.desc("total_sales"))
    )
