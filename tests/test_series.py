import datetime
import statistics
from decimal import Decimal

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from shelfwise import jobs
from shelfwise.checks import queries
from shelfwise.functions.calendar import latest_day
from shelfwise.operators import demand, joins, series
from shelfwise.plans import forecasting

START = datetime.date(2023, 1, 2)


@pytest.fixture
def history(spark):
    """Two series over 40 days, the second with gaps."""
    data = []
    for i in range(40):
        day = START + datetime.timedelta(days=i)
        data.append(("p", day, "x", i % 5 + 1, Decimal("2.50")))
        data.append(("p", day, "x", i % 3, Decimal("3.50")))
        if i % 2 == 0:
            data.append(("q", day, "y", i, Decimal("1.00")))
    return spark.createDataFrame(
        data, "product_id string, date date, county string, quantity int, price decimal(12,2)"
    )


def test_daily_series(history):
    daily = series.daily_series(history)
    assert daily.count() == 60
    row = daily.filter("product_id = 'p' and date = '2023-01-04'").first()
    assert (row.quantity, row.price, row.revenue) == (5, Decimal("3.00000000"), Decimal("14.50"))


def test_features_against_plain_python(history):
    table = series.sales_features(series.daily_series(history)).filter("product_id = 'p'").orderBy("date").collect()
    quantities = [i % 5 + 1 + i % 3 for i in range(40)]
    for i, row in enumerate(table):
        assert row.quantity == quantities[i]
        assert row.prev_day_quantity == (quantities[i - 1] if i >= 1 else 0)
        assert row.prev_week_quantity == (quantities[i - 7] if i >= 7 else 0)
        assert row.prev_month_quantity == (quantities[i - 30] if i >= 30 else 0)
        week = quantities[max(0, i - 6): i + 1]
        assert row.rolling_7d_avg == pytest.approx(statistics.mean(week))
        assert row.rolling_7d_std == pytest.approx(statistics.stdev(week) if i else 0)
        assert row.rolling_3d_avg == pytest.approx(statistics.mean(quantities[max(0, i - 2): i + 1]))
        assert row.rolling_30d_avg == pytest.approx(statistics.mean(quantities[max(0, i - 29): i + 1]))
        day = START + datetime.timedelta(days=i)
        assert row.day_of_week == day.isoweekday() % 7 + 1
        assert row.is_weekend == (1 if day.weekday() >= 5 else 0)
        assert (row.year, row.month, row.day_of_month) == (day.year, day.month, day.day)
    assert set(series.FEATURE_COLUMNS) <= set(table[0].asDict())
    assert len(series.FEATURE_COLUMNS) == 16


def test_frames_in_days_skip_gaps(history):
    daily = series.daily_series(history).filter("product_id = 'q'")
    by_rows = series.sales_features(daily).orderBy("date").collect()[-1]
    by_days = series.sales_features(daily, by_days=True).orderBy("date").collect()[-1]
    assert by_rows.rolling_3d_avg == pytest.approx((38 + 36 + 34) / 3)
    assert by_days.rolling_3d_avg == pytest.approx((38 + 36) / 2)


def test_windows_share_one_shuffle_and_sort(history):
    text = plan(series.sales_features(series.daily_series(history).coalesce(4)))
    assert text.count("Sort [") == 1
    assert text.count("hashpartitioning(product_id") - text.count("hashpartitioning(product_id#") <= 2


def test_latest_before(history):
    daily = series.daily_series(history)
    last = joins.latest_per_series(daily, series.SERIES, ["quantity"], before=F.lit("2023-01-07").cast("date"))
    assert rows(last) == [("p", "x", datetime.date(2023, 1, 6), 6), ("q", "y", datetime.date(2023, 1, 6), 4)]
    assert "Window" not in plan(last) and "SortAggregate" not in plan(last)
    raw = joins.latest_per_series(history, ["product_id"], ["quantity"], tie_break=["price"])
    assert rows(raw.select("product_id", "quantity")) == [("p", 0), ("q", 38)]


def test_future_days(history):
    future = joins.future_days(history, ["product_id", "county"], 3)
    assert future.count() == 6
    assert {r.date for r in future.collect()} == {datetime.date(2023, 2, 11) + datetime.timedelta(days=i) for i in range(3)}
    assert "CartesianProduct" not in plan(future) and "NestedLoop" not in plan(future)


def test_forecast_frame(history):
    frame = forecasting.forecast_frame(series.daily_series(history), days=2)
    row = frame.filter("product_id = 'q'").orderBy("date").first()
    assert row.date == datetime.date(2023, 2, 11)
    assert row.prev_day_quantity == row.rolling_30d_avg == 38
    assert (row.rolling_7d_std, row.price, row.avg_price_7d) == (0.0, 1.0, 1.0)
    assert row.day_of_week == 7 and row.is_weekend == 1


def test_split_is_stable(history):
    daily = series.daily_series(history)
    keys = ["product_id", "county", "date"]
    train, test = forecasting.split_rows(daily, keys)
    again, _ = forecasting.split_rows(daily.repartition(3), keys)
    assert rows(train) == rows(again)
    assert train.count() + test.count() == 60


def test_models(spark, history):
    table = series.sales_features(series.daily_series(history)).cache()
    keys = ["product_id", "county", "date"]
    train, test = forecasting.split_rows(table, keys)
    trained = forecasting.train_models(train, test, names=["random_forest", "linear_regression", "missing"])
    assert set(trained.failed) == {"missing"}
    best = trained.metrics[trained.best_name]["rmse"]
    assert all(best <= m["rmse"] for m in trained.metrics.values())
    metrics = {r.model: r for r in forecasting.model_metrics(spark, trained).collect()}
    assert metrics[trained.best_name].is_best
    daily = series.daily_series(history)
    forecast = forecasting.forecast(trained, daily, days=5)
    assert forecast.columns == ["date", "product_id", "county", "forecast_quantity", "day_of_week", "month", "year"]
    assert forecast.count() == 10
    importance = forecasting.feature_importance(spark, trained, "random_forest").collect()
    assert len(importance) == 16 and sum(r.importance for r in importance) == pytest.approx(1)
    assert [r.importance for r in importance] == sorted((r.importance for r in importance), reverse=True)
    assert forecasting.feature_importance(spark, trained, "linear_regression").count() == 0
    assert forecasting.forecast_accuracy(daily, forecast).count() == 0
    again = forecasting.train_models(train, test, names=["random_forest"])
    assert again.metrics["random_forest"] == trained.metrics["random_forest"]


def test_a_model_that_fails_is_no_result(spark, history, monkeypatch):
    """The queries that fit models raise where one of them fails, whatever the others say."""
    table = series.sales_features(series.daily_series(history))
    line = lambda label: forecasting.LinearRegression(labelCol=label)
    makers = {"random_forest": line, "gradient_boosted": line, "linear_regression": lambda label: line("no such column")}
    with pytest.raises(forecasting.FitError, match="linear_regression: .*no such column"):
        forecasting.train_models(table, table, feature_columns=["price"], estimators=makers, strict=True)
    monkeypatch.setattr(forecasting, "ESTIMATORS", makers)
    monkeypatch.setattr(queries, "_daily", lambda spark, root: series.daily_series(history))
    with pytest.raises(forecasting.FitError, match="linear_regression"):
        queries.model_metrics(spark, "")


def test_forecast_job(spark, history, tmp_path):
    history.write.parquet(str(tmp_path / "refined"))
    trained = jobs.run_forecast(spark, str(tmp_path / "refined"), str(tmp_path / "out"), days=2)
    assert set(trained.models) == set(forecasting.ESTIMATORS) and not trained.failed
    assert spark.read.parquet(str(tmp_path / "out" / "forecasts")).count() == 4
    assert spark.read.parquet(str(tmp_path / "out" / "metrics")).filter("is_best").count() == 1


def test_models_take_categories_of_any_number_of_values(spark):
    """200 products in 49 counties, and products that training did not see."""
    table = spark.range(2000).select(
        F.format_string("p%d", F.col("id") % 200).alias("product_id"), F.format_string("c%d", F.col("id") % 49).alias("county"),
        F.date_add(F.lit(START), (F.col("id") % 31).cast("int")).alias("date"), (F.col("id") % 7).alias("quantity"),
        (F.col("id") % 13).cast("double").alias("price"),
    )
    unseen = table.withColumn("product_id", F.concat("product_id", F.lit("x")))
    trained = forecasting.train_models(table, unseen, feature_columns=["price"], with_categories=True)
    assert set(trained.metrics) == set(forecasting.ESTIMATORS) and not trained.failed
    assert len(trained.feature_columns) == 1 + forecasting.CATEGORY_WIDTH
    importance = forecasting.feature_importance(spark, trained, "random_forest")
    assert importance.count() == len(trained.feature_columns)


def test_a_fit_does_not_depend_on_how_its_input_is_split(history):
    table = series.sales_features(series.daily_series(history))
    names = ["random_forest", "gradient_boosted"]
    few = forecasting.train_models(table.coalesce(1), table, names=names)
    many = forecasting.train_models(table.repartition(7), table, names=names)
    for name in names:
        assert few.metrics[name] == pytest.approx(many.metrics[name], rel=1e-9)


def test_a_forest_that_keeps_node_ids_is_the_same(history):
    table = series.sales_features(series.daily_series(history))
    kept = forecasting.ESTIMATORS["random_forest"]("quantity")
    assert kept.getCacheNodeIds()
    makers = {"kept": lambda label: kept.copy(), "descended": lambda label: kept.copy().setCacheNodeIds(False)}
    trained = forecasting.train_models(table, table, estimators=makers, strict=True)
    trees = [trained.models[name].stages[-1].toDebugString.split("\n", 1)[1] for name in makers]
    assert trees[0] == trees[1]


def test_untrained(history):
    with pytest.raises(ValueError):
        forecasting.forecast(forecasting.TrainedModels(), series.daily_series(history))


def test_error_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0)], "y double, p double")
    row = forecasting.error_metrics(df, "y", "p").first()
    assert (row.n, row.mae) == (3, pytest.approx(1.0))
    assert row.rmse == pytest.approx((5 / 3) ** 0.5)
    assert row.r2 == pytest.approx(1 - 5 / 8)


def test_forecast_accuracy_matches_on_three_keys(history):
    daily = series.daily_series(history)
    forecasts = daily.select("date", *series.SERIES, (F.col("quantity") + 1.0).alias("forecast_quantity"))
    row = forecasting.forecast_accuracy(daily, forecasts).first()
    assert (row.n, row.rmse, row.mae) == (60, 1.0, 1.0)


def test_only_forecasts_that_may_have_an_actual_are_dealt_out(spark):
    """Of 400 forecasts those with an actual go on, none is lost, and equal, odd and null keys are as in a plain join."""
    forecasts = spark.range(400).select(
        F.date_add(F.lit(START), (F.col("id") % 20).cast("int")).alias("date"), F.concat(F.lit("p"), F.col("id") % 200).alias("product_id"),
        F.when(F.col("id") % 7 > 0, "x").alias("county"), F.col("id").cast("double").alias("forecast_quantity"),
    )
    actuals = forecasts.filter("forecast_quantity in (1, 2, 7, 201)").select("date", "product_id", "county", (F.col("forecast_quantity") + 1).alias("quantity"))
    by = ["date", "product_id", "county"]
    left = joins.may_match(forecasts, actuals, by)
    assert left.columns == forecasts.columns and sorted(r[3] for r in left.collect()) == [1, 2, 7, 201, 202]
    assert joins.may_match(forecasts, actuals, by, bits=64).count() < 400 == joins.may_match(forecasts, forecasts, by, bits=64).count()
    assert joins.may_match(forecasts, actuals.limit(0), by).count() == 0
    assert rows(joins.match_on(left, actuals, by)) == rows(joins.match_on(forecasts, actuals, by))
    assert "_marks" in plan(forecasting.forecast_accuracy(actuals, forecasts))
    row = forecasting.forecast_accuracy(actuals, forecasts).first()
    plain = forecasting.forecast_accuracy(actuals.withColumn("date", F.col("date").cast("timestamp")), forecasts).first()
    assert (row.n, row.mae) == (plain.n, plain.mae)


def test_trend_of_a_line_is_the_line(spark):
    days = spark.range(30).select(
        F.lit("x").alias("county"), F.date_add(F.lit(START), F.col("id").cast("int")).alias("date"),
        (F.col("id") * 2 + 5).alias("quantity"),
    )
    forecast = demand.forecast_trends(days, 3).orderBy("date").collect()
    assert [r.prediction for r in forecast] == pytest.approx([65, 67, 69])
    single = demand.fit_trends(days.limit(1)).first()
    assert (single.slope, single.intercept) == (0.0, 5.0)


def test_stock_levels(spark):
    df = spark.createDataFrame([("x", 8.0), ("x", 10.0), ("x", 12.0)], "county string, prediction double")
    row = demand.stock_levels(df, lead_time_days=7, order_cost=50, holding_cost=2).first()
    assert row.avg_daily_demand == 10
    assert row.safety_stock == pytest.approx(3.3)
    assert row.reorder_point == pytest.approx(73.3)
    assert row.economic_order_quantity == pytest.approx((2 * 3650 * 50 / 2) ** 0.5)


def test_latest_day_is_lazy(history):
    assert history.filter(F.col("date") == latest_day(history)).count() == 2


def test_trees_on_equal_rows_are_fitted_on_weighted_ones(spark):
    """Boosted trees are the same as on single rows, and a forest reads no more rows than the kinds allow."""
    rows = spark.range(4000).select(
        F.col("id").cast("string").alias("product_id"), (F.col("id") % 3).cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("y")
    ).withColumn("quantity", 5 * F.col("x") + F.col("x") * F.col("y"))
    merged = forecasting.merge_equal(rows, ["x", "y", "quantity"], ["product_id"])
    assert merged.count() <= 6 * forecasting.EQUAL_ROWS
    assert merged.agg(F.sum(forecasting.ROW_WEIGHT)).first()[0] == 4000
    assert not forecasting.takes_weights(forecasting.GBTRegressor(subsamplingRate=0.5))
    assert not forecasting.takes_weights(forecasting.GBTRegressor(minInstancesPerNode=2))
    assert not forecasting.takes_weights(forecasting.LinearRegression())
    weighted = []

    class Watched(forecasting.GBTRegressor):
        def fit(self, dataset, params=None):
            weighted.append((self.isDefined("weightCol"), dataset.count()))
            return super().fit(dataset, params)

    def fit(maker):
        return forecasting.train_models(rows, rows, feature_columns=["x", "y"], estimators={"trees": maker})

    many = fit(lambda label: Watched(labelCol=label, maxDepth=3, maxIter=3, seed=1))
    plain = fit(lambda label: Watched(labelCol=label, maxDepth=3, maxIter=3, seed=1, minInstancesPerNode=2))
    assert weighted[0][0] and weighted[0][1] == merged.count() and weighted[1] == (False, 4000)
    assert many.metrics["trees"] == pytest.approx(plain.metrics["trees"])
    forest = fit(lambda label: forecasting.ESTIMATORS["random_forest"](label).setNumTrees(5))
    assert not forest.failed and forest.metrics["trees"]["n"] == 4000
