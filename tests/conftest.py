from __future__ import annotations

import datetime

import pytest

from shelfwise.session import get_session

SALES_ROWS = [
    ("T10", "2024-02-28", "Nyeri", 4, 12.50),
    ("T20", "2024-02-28", "Isiolo", 3, 8.75),
    ("T10", "2024-02-29", "Nyeri", 6, 12.50),
    ("T30", "2024-03-01", "Kitui", 2, 140.00),
    ("T20", "2024-03-02", "Nyeri", 5, 8.75),
]
PRODUCT_ROWS = [
    ("T10", "Kettle", "Kitchen"),
    ("T20", "Teapot", "Kitchen"),
    ("T30", "Garden Bench", "Outdoor"),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sales(spark):
    rows = [(p, datetime.date.fromisoformat(d), c, q, price) for p, d, c, q, price in SALES_ROWS]
    df = spark.createDataFrame(rows, "product_id string, date date, county string, quantity int, price double")
    return df.withColumn("price", df.price.cast("decimal(12,2)"))


@pytest.fixture
def float_sales(spark):
    return spark.createDataFrame(
        SALES_ROWS, "product_id string, date string, county string, quantity int, price float"
    )


@pytest.fixture
def products(spark):
    return spark.createDataFrame(PRODUCT_ROWS, "product_id string, product_name string, category string")


@pytest.fixture(scope="session")
def tables():
    return "/root/testdata/sf0.001"


def rows(df) -> list[tuple]:
    """The rows as tuples, in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
