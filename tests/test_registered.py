"""Every registered query against its SQL, on the smallest tables."""

import re
import sys
from pathlib import Path

import pytest
from conftest import plan

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as contract  # noqa: E402
from shelfwise.checks import run  # noqa: E402
from shelfwise.checks.oracles import ORACLES  # noqa: E402
from shelfwise.checks.queries import QUERIES  # noqa: E402

SLOW = {"model_metrics", "forecast", "feature_importance"}


@pytest.fixture(scope="module")
def connection(tables):
    return run.connect(tables)


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert set(QUERIES) - set(ORACLES) == SLOW | {"forecast_accuracy", "kmeans_profile"}
    assert all(re.match(r"op\d+_|pipeline$", name) for name in set(contract.queries()) - set(QUERIES))


def test_entry(spark):
    assert contract.entry(spark).count() >= 250


def test_checks_and_bounds_read_only_what_they_need(spark, tables):
    assert "Join" not in plan(QUERIES["quality_checks"](spark, tables))
    assert plan(QUERIES["step_counts"](spark, tables)).count("lineitem.parquet") == 1
    assert "GreaterThanOrEqual(l_shipdate" in plan(QUERIES["insight_11"](spark, tables))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, connection, tables, name):
    assert run.compare(spark, connection, tables, name) is None
