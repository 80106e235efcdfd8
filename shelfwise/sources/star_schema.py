"""Canonical retail tables taken from the star-schema Parquet tables.

A sale is a line item: the product is the part, the county is the name of the nation of
the customer who ordered, the price is the unit price in whole cents. Each function reads
only what its columns need; ``county=False`` leaves three joins out.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PRICE_TYPE = "decimal(12,2)"


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def _unit_price() -> Column:
    unit_cents = F.expr(
        "cast(round(l_extendedprice * 100) as bigint) div nullif(cast(l_quantity as bigint), 0)"
    )
    return (unit_cents * F.lit(Decimal("0.01"))).cast(PRICE_TYPE)


def order_counties(spark: SparkSession, root: str) -> DataFrame:
    """Order key and county; customers and nations are joined before the large orders side."""
    nations = table(spark, root, "nation").select("n_nationkey", F.col("n_name").alias("county"))
    customers = (
        table(spark, root, "customer")
        .select("c_custkey", "c_nationkey")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("c_custkey", "county")
    )
    return (
        table(spark, root, "orders")
        .select("o_orderkey", "o_custkey")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select("o_orderkey", "county")
    )


def sales(spark: SparkSession, root: str, county: bool = True, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per sale: product_id, date, county, quantity, price and any ``extra`` line columns."""
    lines = table(spark, root, "lineitem").select(
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _unit_price().alias("price"),
        "l_orderkey",
        *[c for c in extra if c != "l_orderkey"],
    )
    if county:
        counties = order_counties(spark, root)
        lines = lines.join(counties, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    names = ["product_id", "date", *(["county"] if county else []), "quantity", "price"]
    return lines.select(*names, *extra)


def products(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
    )


def raw_sales(spark: SparkSession, root: str, county: bool = True, extra: tuple[str, ...] = ()) -> DataFrame:
    """Sales as text with missing, negative and malformed values, the same on every read."""
    key = F.col("l_orderkey")
    text = F.col("price").cast("string")
    price = (
        F.when(key % 17 == 0, F.lit("n/a"))
        .when(key % 13 == 0, F.concat(F.lit("-"), text))
        .when(key % 11 == 0, F.lit(None).cast("string"))
        .otherwise(text)
    )
    quantity = F.when(key % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("quantity").cast("string"))
    product = F.when(key % 19 == 0, F.lit("")).otherwise(F.col("product_id"))
    clean = sales(spark, root, county, extra=("l_orderkey", *[c for c in extra if c != "l_orderkey"]))
    return clean.select(
        product.alias("product_id"),
        F.col("date").cast("string").alias("date"),
        *(["county"] if county else []),
        quantity.alias("quantity"),
        price.alias("price"),
        *extra,
    )


def raw_products(spark: SparkSession, root: str) -> DataFrame:
    """Products of which some go by another id, so that their sales match none, and some lack a name."""
    key = F.col("p_partkey")
    text = key.cast("string")
    return table(spark, root, "part").select(
        F.when(key % 10 == 0, F.concat(F.lit("old-"), text)).otherwise(text).alias("product_id"),
        F.when(key % 23 == 0, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("product_name"),
        F.col("p_type").alias("category"),
    )


def purchases(spark: SparkSession, root: str) -> DataFrame:
    """One row per purchase: customer_id, date, amount."""
    return table(spark, root, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.round("o_totalprice", 2).cast("decimal(18,2)").alias("amount"),
    )


def customers(spark: SparkSession, root: str) -> DataFrame:
    """One row per customer with a purchase: customer_id, registration_year (of the first one), purchases, amount, county."""
    bought = purchases(spark, root).groupBy("customer_id").agg(
        F.year(F.min("date")).alias("registration_year"), F.count(F.lit(1)).alias("purchases"), F.sum("amount").alias("amount")
    )
    nations = table(spark, root, "nation").select("n_nationkey", F.col("n_name").alias("county"))
    known = table(spark, root, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("n_nationkey"))
    return bought.join(known, "customer_id").join(nations, "n_nationkey", "left").drop("n_nationkey")
