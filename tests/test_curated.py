import datetime
from decimal import Decimal

import pytest
from conftest import plan, rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from shelfwise.operators import cleaning, curated, joins, ranking
from shelfwise.plans import curate, insights


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_sales_by_product(sales, products):
    result = by_key(curated.sales_by_product(sales, products), "product_id")
    kettle = result[("T10",)]
    assert (kettle.total_quantity, kettle.transaction_count) == (10, 2)
    assert kettle.total_revenue == pytest.approx(125.0)
    assert (kettle.product_name, kettle.category) == ("Kettle", "Kitchen")
    assert (kettle.avg_price, kettle.max_price, kettle.min_price) == (12.5, 12.5, 12.5)
    assert len(result) == 3


def test_sales_by_county_counts_rows_with_product(sales):
    extra = sales.limit(1).withColumn("product_id", F.lit(None).cast("string"))
    result = by_key(curated.sales_by_county(sales.unionByName(extra)), "county")
    nyeri = result[("Nyeri",)]
    assert (nyeri.transaction_count, nyeri.unique_products) == (4, 3)
    assert nyeri.avg_transaction_value == pytest.approx((50 * 2 + 75 + 43.75) / 4)


def test_result_is_sorted(sales, products):
    totals = [r.total_revenue for r in curated.sales_by_category(sales, products).collect()]
    assert totals == sorted(totals, reverse=True)


FUNCTIONS = [
    curated.sales_by_product, curated.sales_by_category, curated.county_product_sales, curated.comprehensive_view,
    curated.sales_by_county, ranking.top_items_per_county,
]


@pytest.mark.parametrize("function", FUNCTIONS)
def test_summing_before_the_join_equals_joining_first(spark, sales, products, function):
    """Also with a product listed twice, twice under two names, and one that is missing."""
    listed = spark.createDataFrame(
        [("T10", "Kettle", "Kitchen"), ("T10", "Kettle", "Kitchen"), ("T10", "Samovar", "Kitchen"),
         ("T20", None, "Kitchen")],
        products.schema,
    )
    before = function(sales, listed)
    after = function(joins.join_products(sales, listed))
    assert before.columns == after.columns
    assert rows(before) == rows(after)


def test_float_prices_sum_as_doubles(float_sales, products):
    result = by_key(curated.sales_by_product(float_sales, products), "product_id")
    assert result[("T10",)].total_revenue == pytest.approx(125.0, abs=1e-4)
    assert dict(curated.comprehensive_view(float_sales, products).dtypes)["total_revenue"] == "double"


def test_curated_tables_equal_the_single_functions(sales, products):
    refined = joins.join_products(sales, products)
    tables = curate.curated_tables(curate.curated_sums(sales, products))
    assert rows(tables["sales_by_product"]) == rows(curated.sales_by_product(refined))
    assert rows(tables["sales_by_county"]) == rows(curated.sales_by_county(refined))
    assert rows(tables["sales_by_category"]) == rows(curated.sales_by_category(refined))
    assert rows(tables["top_items_per_county"]) == rows(ranking.top_items_per_county(refined))
    assert rows(tables["comprehensive_view"]) == rows(curated.comprehensive_view(refined))


def test_unknown_product_keeps_nulls(sales, products):
    known = products.filter("product_id <> 'T30'")
    refined = joins.join_products(sales, known)
    assert refined.count() == 5
    row = refined.filter("product_id = 'T30'").first()
    assert (row.product_name, row.category) == (None, None)


def test_sales_column_wins_over_product_column(sales, products):
    joined = joins.join_products(sales, products.withColumn("county", F.lit("elsewhere")))
    assert joined.columns.count("county") == 1
    assert joined.filter("county = 'elsewhere'").count() == 0


def test_metrics(sales, products):
    row = curated.aggregate_metrics(curated.sales_by_product(sales, products)).first()
    assert (row.group_count, row.grand_total) == (3, pytest.approx(475.0))
    assert row.mean_group_total == pytest.approx(475.0 / 3)
    top = curated.top_items_metrics(ranking.top_items_per_county(sales, products)).first()
    assert (top.total_combinations, top.groups_analyzed, top.avg_items_per_group) == (4, 3, pytest.approx(4 / 3))


def test_metrics_of_nothing(sales, products):
    row = curated.aggregate_metrics(curated.sales_by_product(sales.limit(0), products)).first()
    assert (row.group_count, row.grand_total, row.mean_group_total) == (0, None, None)


def test_ranking(sales, products):
    nyeri = ranking.top_items_per_county(sales, products).filter("county = 'Nyeri'").collect()
    assert [(r.product_id, r.revenue_rank) for r in nyeri] == [("T10", 1), ("T20", 2)]


def test_ties_share_a_rank_but_not_a_number(spark):
    df = spark.createDataFrame([("a", f"p{i}", 10) for i in range(4)] + [("a", "q", 99)], "g string, p string, v int")
    ranked = ranking.rank_within(df, ["g"], "v", "r", 2)
    assert sorted(r.r for r in ranked.collect()) == [1, 2, 2, 2, 2]
    numbered = ranking.number_within(df, ["g"], "v", ["p"], "r", 2)
    assert rows(numbered.select("p", "r")) == [("p0", 2), ("q", 1)]


def test_group_limit_is_applied_before_the_shuffle(sales, products):
    text = plan(ranking.top_items_per_county(sales, products))
    assert "WindowGroupLimit" in text and "Partial" in text


sale = st.tuples(
    st.sampled_from(["p", "q", "r", None]), st.sampled_from(["x", "y"]), st.integers(0, 50),
    st.integers(0, 99_999).map(lambda cents: Decimal(cents) / 100),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.lists(sale, min_size=1, max_size=30))
def test_totals_agree_at_every_grain(spark, products, data):
    sales = spark.createDataFrame(
        [(p, datetime.date(2023, 1, 1), c, q, price) for p, c, q, price in data],
        "product_id string, date date, county string, quantity int, price decimal(12,2)",
    )
    expected = sum(q * price for _, _, q, price in data)
    for function in (curated.sales_by_product, curated.sales_by_county, curated.comprehensive_view):
        result = function(sales, products, money=None)
        assert result.agg(F.sum("total_revenue")).first()[0] == expected
        assert result.agg(F.sum("transaction_count")).first()[0] == len(data)


def test_step_counts(sales, products):
    assert rows(curated.step_counts({"a": sales, "b": products})) == [("a", 5), ("b", 3)]


def test_counts_of_refining_equal_the_counts_of_its_steps(spark):
    sales = spark.createDataFrame(
        [("a", "2", "1.5"), ("a", "-1", "1"), ("b", None, None), ("b", "1", "n/a"), (None, "1", "1"), ("c", "1", "1")],
        "product_id string, quantity string, price string",
    )
    products = spark.createDataFrame([("a", "x"), ("a", "y"), ("z", None)], "product_id string, product_name string")
    products = products.withColumn("category", F.lit("k"))
    cleaned, listed = cleaning.clean_sales(sales), cleaning.clean_products(products)
    steps = {"sales_raw": sales, "products_raw": products, "sales_cleaned": cleaned, "products_cleaned": listed,
             "joined": joins.join_products(cleaned, listed)}
    assert rows(curated.refine_counts(sales, products)) == rows(curated.step_counts(steps))
    nothing = curated.refine_counts(sales.limit(0), products.limit(0))
    assert {r.row_count for r in nothing.collect()} == {0} and nothing.count() == 5


def test_totals_beyond_64_bits(spark):
    """4 million sales whose revenue in units of 1e-8 needs more than 63 bits."""
    sales = spark.range(4_000_000).select(
        F.lit("x").alias("county"), F.lit("p").alias("product_id"), F.lit(Decimal(1000)).cast("decimal(18,8)").alias("price"),
        F.lit(50).alias("quantity"),
    )
    assert insights.county_sales(sales).first().total_revenue == 4_000_000 * 50_000
    assert curated.sales_by_county(sales, money=None).first().total_revenue == 4_000_000 * 50_000
    refund = sales.limit(3).withColumn("quantity", F.lit(-1))
    assert insights.county_sales(refund).first().total_revenue == -3000


def test_ranking_takes_the_sums_as_they_are(sales, products):
    sums = curate.curated_sums(sales, products)
    tables = curate.curated_tables(sums)
    assert plan(tables["top_items_per_county"]).count("HashAggregate") == plan(sums).count("HashAggregate")
