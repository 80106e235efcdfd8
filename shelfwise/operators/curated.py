"""Curated aggregates of sales.

All of them are finished from the same additive sums. So one pass over the sales, at the
grain of county and product, serves every curated table, and products are joined to
the sums rather than to the sales: a product that has a third of all sales is then one
row per county in that join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions.measures import UNITS, ratio, revenue_units, unit_sum, with_price_units
from shelfwise.operators.cleaning import is_kept
from shelfwise.operators.joins import join_products

BY_PRODUCT = ("product_id", "product_name", "category")
BY_COUNTY_PRODUCT = ("county", "product_id", "product_name", "category")
BY_ALL = ("county", "category", "product_id", "product_name")

ADDED = ("revenue_sum", "revenue_n", "quantity_sum", "price_sum", "price_n", "row_n", "product_n")
PRICED = ("revenue_sum", "price_sum", "price_max", "price_min")
COPIES = "_copies"


def _unit_sums(sales: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Additive sums by ``keys`` of sales with price units."""
    priced = F.col(UNITS).isNotNull()
    sold = F.col("quantity").isNotNull()
    return sales.groupBy(*keys).agg(
        unit_sum(sales, revenue_units(), "quantity").alias("revenue_sum"),
        F.count_if(priced & sold).alias("revenue_n"),
        F.sum("quantity").alias("quantity_sum"),
        unit_sum(sales, F.col(UNITS)).alias("price_sum"),
        F.count(UNITS).alias("price_n"),
        F.count(F.lit(1)).alias("row_n"),
        F.count("product_id").alias("product_n"),
        F.max(UNITS).alias("price_max"),
        F.min(UNITS).alias("price_min"),
    )


def roll_up(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same sums at a coarser grain."""
    return sums.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in ADDED],
        F.max("price_max").alias("price_max"),
        F.min("price_min").alias("price_min"),
    )


def _attach_products(sums: DataFrame, products: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sums by product with product columns; a product listed n times counts n times.

    The copies are counted on the product side, so the sums, which are the larger side by
    far, need no second aggregation.
    """
    listed = products.groupBy(F.col("product_id").cast("string").alias("product_id"), *columns).agg(
        F.count(F.lit(1)).alias(COPIES)
    )
    joined = join_products(sums, listed)
    copies = F.coalesce(COPIES, F.lit(1))
    return joined.withColumns({name: F.col(name) * copies for name in ADDED}).drop(COPIES)


def sums_with_products(sales: DataFrame, products: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Sums by ``keys``, some of which may be product columns that ``products`` has.

    Without ``products`` the sales carry those columns themselves, as the refined layer does.
    """
    sales, back = with_price_units(sales)
    if products is None:
        sums = _unit_sums(sales, keys)
    else:
        base = [k for k in keys if k in sales.columns and k != "product_id"] + ["product_id"]
        columns = [k for k in keys if k not in base]
        sums = _attach_products(_unit_sums(sales, base), products, columns)
        if "product_id" not in keys:
            sums = roll_up(sums, keys)
    return sums.withColumns({name: back(F.col(name)) for name in PRICED})


def _total(money: str | None) -> Column:
    total = F.col("revenue_sum")
    return (total.cast(money) if money else total).alias("total_revenue")


def _price(name: str, money: str | None) -> Column:
    return (F.col(name).cast(money) if money else F.col(name)).alias(f"{name[6:]}_price")


QUANTITY = ("quantity_sum", "total_quantity")
ROWS = ("row_n", "transaction_count")
# the number of sales with a product id, not of different products
PRODUCTS_COUNTED = ("product_n", "unique_products")


def _named(pair: tuple[str, str]) -> Column:
    return F.col(pair[0]).alias(pair[1])


def _average_price() -> Column:
    return ratio(F.col("price_sum"), F.col("price_n")).alias("avg_price")


def _sorted(df: DataFrame, ordered: bool, *order: Column) -> DataFrame:
    return df.orderBy(*order) if ordered else df


def finish_by_product(sums: DataFrame, money: str | None = "double") -> DataFrame:
    return sums.select(
        *BY_PRODUCT, _total(money), _named(QUANTITY), _average_price(), _named(ROWS),
        _price("price_max", money), _price("price_min", money),
    )


def finish_by_county(sums: DataFrame, money: str | None = "double") -> DataFrame:
    average = ratio(F.col("revenue_sum"), F.col("revenue_n")).alias("avg_transaction_value")
    return sums.select("county", _total(money), _named(QUANTITY), _named(ROWS), _named(PRODUCTS_COUNTED), average)


def finish_by_category(sums: DataFrame, money: str | None = "double") -> DataFrame:
    return sums.select(
        "category", _total(money), _named(QUANTITY), _named(ROWS), _named(PRODUCTS_COUNTED), _average_price()
    )


def finish_by_county_product(sums: DataFrame, money: str | None = "double") -> DataFrame:
    return sums.select(*BY_COUNTY_PRODUCT, _total(money), _named(QUANTITY), _named(ROWS))


def finish_comprehensive(sums: DataFrame, money: str | None = "double") -> DataFrame:
    return sums.select(
        *BY_ALL, _total(money), _named(QUANTITY), _named(ROWS), _average_price(),
        _price("price_max", money), _price("price_min", money),
    )


def sales_by_product(
    sales: DataFrame, products: DataFrame | None = None, ordered: bool = True, money: str | None = "double"
) -> DataFrame:
    """Totals, price statistics and sale count by product, the largest revenue first."""
    result = finish_by_product(sums_with_products(sales, products, BY_PRODUCT), money)
    return _sorted(result, ordered, F.desc("total_revenue"))


def sales_by_county(
    sales: DataFrame, products: DataFrame | None = None, ordered: bool = True, money: str | None = "double"
) -> DataFrame:
    """Totals, sale count and mean revenue of a sale by county, the largest revenue first.

    ``products`` matters only where it lists a product twice.
    """
    result = finish_by_county(sums_with_products(sales, products, ["county"]), money)
    return _sorted(result, ordered, F.desc("total_revenue"))


def sales_by_category(
    sales: DataFrame, products: DataFrame | None = None, ordered: bool = True, money: str | None = "double"
) -> DataFrame:
    """Totals, counts and mean price by category, the largest revenue first."""
    result = finish_by_category(sums_with_products(sales, products, ["category"]), money)
    return _sorted(result, ordered, F.desc("total_revenue"))


def county_product_sales(
    sales: DataFrame, products: DataFrame | None = None, money: str | None = "double"
) -> DataFrame:
    """Totals and sale count by county and product."""
    return finish_by_county_product(sums_with_products(sales, products, BY_COUNTY_PRODUCT), money)


def comprehensive_view(
    sales: DataFrame, products: DataFrame | None = None, ordered: bool = True, money: str | None = "double"
) -> DataFrame:
    """Totals, price statistics and sale count by county, category and product."""
    result = finish_comprehensive(sums_with_products(sales, products, BY_ALL), money)
    return _sorted(result, ordered, F.asc("county"), F.asc("category"), F.desc("total_revenue"))


def aggregate_metrics(df: DataFrame, total: str = "total_revenue") -> DataFrame:
    """One row over an aggregate: number of groups, grand total, mean of the group totals."""
    return df.agg(
        F.count(F.lit(1)).alias("group_count"),
        F.sum(total).cast("double").alias("grand_total"),
        ratio(F.sum(total), F.count(total)).alias("mean_group_total"),
    )


def top_items_metrics(df: DataFrame, group: str = "county") -> DataFrame:
    """One row over a ranking: its rows, its groups, and rows per group."""
    rows, groups = F.count(F.lit(1)), F.count_distinct(group)
    return df.agg(
        rows.alias("total_combinations"),
        groups.alias("groups_analyzed"),
        ratio(rows, groups).alias("avg_items_per_group"),
    )


def refine_counts(raw_sales: DataFrame, raw_products: DataFrame, price_type: str = "float") -> DataFrame:
    """Row counts of the steps of refining, from one pass over each raw table.

    The joined rows come from cleaned sales by product times how often the product is listed;
    neither side is joined row by row. Cleaning keeps every product.
    """
    by_product = raw_sales.groupBy(F.col("product_id").cast("string").alias("product_id")).agg(
        F.count(F.lit(1)).alias("raw"), F.count_if(is_kept(raw_sales, price_type)).alias("cleaned")
    )
    listed = raw_products.groupBy(F.col("product_id").cast("string").alias("product_id")).agg(
        F.count(F.lit(1)).alias(COPIES)
    )
    sales = by_product.join(listed, "product_id", "left").agg(
        F.coalesce(F.sum("raw"), F.lit(0)).alias("sales_raw"),
        F.coalesce(F.sum("cleaned"), F.lit(0)).alias("sales_cleaned"),
        F.coalesce(F.sum(F.col("cleaned") * F.coalesce(COPIES, F.lit(1))), F.lit(0)).alias("joined"),
    )
    names = ("sales_raw", "sales_cleaned", "joined")
    pairs = F.array(*[F.struct(F.lit(n).alias("step"), F.col(n).alias("row_count")) for n in names])
    products = step_counts({"products_raw": raw_products}).withColumn(
        "step", F.explode(F.array(F.lit("products_raw"), F.lit("products_cleaned")))
    )
    return sales.select(F.inline(pairs)).unionByName(products)


def step_counts(steps: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named step."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("step"), "row_count")
              for name, df in steps.items()]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
