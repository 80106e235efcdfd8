import datetime
from decimal import Decimal

from conftest import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from shelfwise.operators.cleaning import clean_products, clean_sales
from shelfwise.operators.enrichment import add_county, county_weights

RAW = "product_id string, date string, county string, quantity string, price string"


def test_missing_becomes_zero_and_malformed_or_negative_goes(spark):
    raw = spark.createDataFrame(
        [
            ("a", "2023-01-01", "x", None, None),
            ("b", "2023-01-01", "x", "2", "-1.0"),
            ("c", "2023-01-01", "x", "-2", "1.0"),
            ("d", "2023-01-01", "x", "two", "1.0"),
            ("e", "2023-01-01", "x", "2", "n/a"),
            ("f", "2023-13-01", "x", "3.7", "1.5"),
            ("g", "2023-01-01", "x", "1", "NaN"),
        ],
        RAW,
    )
    cleaned = {r.product_id: r for r in clean_sales(raw).collect()}
    assert set(cleaned) == {"a", "f", "g"}
    assert (cleaned["a"].quantity, cleaned["a"].price) == (0, 0.0)
    assert (cleaned["f"].quantity, cleaned["f"].price, cleaned["f"].date) == (3, 1.5, None)
    assert cleaned["a"].date == datetime.date(2023, 1, 1)
    assert "g" not in {r.product_id for r in clean_sales(raw, drop_nan=True).collect()}
    exact = clean_sales(raw, "decimal(12,2)").filter("product_id = 'f'").first()
    assert exact.price == Decimal("1.50")


def test_typed_input_and_nan(spark):
    raw = spark.createDataFrame(
        [(7, None, 1.5), (8, 2, float("nan")), (9, 3, -1.0)], "product_id int, quantity int, price double"
    )
    assert rows(clean_sales(raw)) == [("7", 0, 1.5), ("8", 2, 0.0)]


def test_products_unknown(spark):
    raw = spark.createDataFrame([(1, None, "A"), (2, "x", None)], "product_id int, product_name string, category string")
    assert rows(clean_products(raw)) == [("1", "Unknown", "A"), ("2", "x", "Unknown")]


values = st.one_of(st.none(), st.sampled_from(["", "x", "-1", "0", "2", "3.5", "1e3", "NaN"]), st.integers(-9, 9).map(str))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.lists(st.tuples(st.text("ab", max_size=2), values, values), min_size=1, max_size=12))
def test_cleaning_twice_changes_nothing(spark, data):
    raw = spark.createDataFrame(data, "product_id string, quantity string, price string")
    once = clean_sales(raw, "double", drop_nan=True)
    assert rows(clean_sales(once, "double", drop_nan=True)) == rows(once)
    assert once.filter((F.col("price") < 0) | (F.col("quantity") < 0)).count() == 0


def test_county_weights_match_the_shares():
    weights = dict(county_weights())
    total = sum(weights.values())
    assert len(weights) == 49
    assert weights["Nairobi"] / total == 0.30
    assert weights["Mombasa"] / total == 0.15
    assert weights["Kilifi"] == 2 * weights["Thika"]
    large = sum(weights[c] for c in ("Nairobi", "Mombasa", "Kisumu", "Nakuru", "Eldoret"))
    assert large / total == 0.70


def test_county_draw_is_repeatable_and_near_its_weights(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "k")
    first = add_county(keys, ["k"])
    assert first.exceptAll(add_county(keys.repartition(7), ["k"])).count() == 0
    share = first.filter("county = 'Nairobi'").count() / 20_000
    assert abs(share - 0.30) < 0.02
    assert first.filter("county is null").count() == 0


def test_existing_county_is_kept(sales):
    assert add_county(sales, ["product_id"]) is sales
