import datetime
import os
from pathlib import Path

import pytest
from conftest import PRODUCT_ROWS, SALES_ROWS, plan, rows
from pyspark.sql import functions as F

from shelfwise import jobs, schemas, session
from shelfwise.operators import curated
from shelfwise.plans import curate, insights, insights_sql, refine
from shelfwise.sources import readers, sinks


def write_raw(root: Path) -> None:
    for name, header, data in (
        ("sales", "product_id,date,county,quantity,price", SALES_ROWS),
        ("products", "product_id,product_name,category", PRODUCT_ROWS),
    ):
        (root / name).mkdir(parents=True)
        half = len(data) // 2
        for part, chunk in enumerate((data[:half], data[half:])):
            lines = [header, *(",".join(map(str, row)) for row in chunk)]
            (root / name / f"{part}.csv").write_text("\n".join(lines) + "\n")


def files(path) -> list[Path]:
    return list(Path(path).rglob("*.parquet"))


def test_csv_scan_with_and_without_schema(spark, tmp_path):
    write_raw(tmp_path)
    sales, products = readers.read_raw(spark, str(tmp_path))
    assert (sales.count(), products.count()) == (5, 3)
    assert set(dict(sales.dtypes).values()) == {"string"}
    inferred = dict(readers.read_csv(spark, str(tmp_path / "sales")).dtypes)
    assert (inferred["quantity"], inferred["price"]) == ("int", "double")


def test_corrupt_rows_can_be_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text("product_id,date,county,quantity,price\na,2023-01-01,x,two,1.5\n")
    df = readers.read_csv(spark, str(tmp_path), schemas.SALES, keep_corrupt=True)
    row = df.first()
    assert row.quantity is None and "two" in row[readers.CORRUPT]


def test_text_partition_values_stay_text(spark, tmp_path):
    df = spark.createDataFrame([("007", 1)], "county string, v int")
    sinks.write_layer(df, str(tmp_path / "t"), ["county"])
    assert readers.read_layer(spark, str(tmp_path / "t")).first().county == "007"


def test_refine_and_curate_jobs(spark, tmp_path):
    write_raw(tmp_path / "raw")
    result = refine.run_refine(
        spark, str(tmp_path / "raw"), str(tmp_path / "refined"), str(tmp_path / "audit"),
        price_type="decimal(12,2)", min_rows=4,
    )
    assert result.passed
    assert result.row_counts == {"sales_raw": 5, "products_raw": 3, "joined": 5}
    assert (tmp_path / "refined" / "date=2024-02-28" / "county=Nyeri").is_dir()
    paths = curate.run_curate(spark, str(tmp_path / "refined"), str(tmp_path / "curated"), str(tmp_path / "audit"))
    assert set(paths) == set(sinks.CURATED_LAYOUT)
    assert (tmp_path / "curated" / "sales_by_product" / "category=Kitchen").is_dir()
    by_product = {r.product_id: r for r in readers.read_layer(spark, paths["sales_by_product"]).collect()}
    assert (by_product["T10"].total_quantity, by_product["T10"].transaction_count) == (10, 2)
    assert by_product["T10"].total_revenue == pytest.approx(125.0)
    runs = readers.read_audit(spark, str(tmp_path / "audit" / "runs")).collect()
    assert {r.job_name for r in runs} == {"refine", "curate"}
    metrics = next(r for r in runs if r.job_name == "curate").metrics
    assert metrics["sales_by_product.group_count"] == "3"
    checks = readers.read_audit(spark, str(tmp_path / "audit" / "quality")).first()
    assert checks.overall_status == "PASSED"


def test_job_command_line(spark, tmp_path, capsys):
    write_raw(tmp_path / "raw")
    raw, refined, curated_root = (str(tmp_path / n) for n in ("raw", "refined", "curated"))
    jobs.main(["refine", "--raw", raw, "--refined", refined, "--price-type", "decimal(12,2)"])
    jobs.main(["curate", "--refined", refined, "--curated", curated_root])
    printed = capsys.readouterr().out
    assert "min_rows_check: FAILED (5)" in printed and "no_negative_prices_check: PASSED (0)" in printed
    assert readers.read_layer(spark, f"{curated_root}/sales_by_county").count() == 3


def test_failed_checks_warn_unless_strict(spark, tmp_path):
    write_raw(tmp_path / "raw")
    target = tmp_path / "refined"
    with pytest.raises(refine.QualityError):
        refine.run_refine(spark, str(tmp_path / "raw"), str(target), strict=True)
    assert not target.exists()
    result = refine.run_refine(spark, str(tmp_path / "raw"), str(target))
    assert not result.passed and target.exists()
    strict = refine.run_refine(spark, str(tmp_path / "raw"), str(tmp_path / "again"), strict=True, min_rows=1)
    assert strict.passed


def test_overwrite_replaces_the_schema(spark, sales, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_refined(sales, path)
    sinks.write_refined(sales.drop("price").withColumn("note", F.lit("x")), path)
    assert set(readers.read_layer(spark, path).columns) == {"product_id", "quantity", "note", "date", "county"}


def test_compaction_leaves_fewer_files_and_the_same_rows(spark, sales, tmp_path):
    source, target = str(tmp_path / "small"), str(tmp_path / "large")
    many = sales.crossJoin(spark.range(200)).withColumn("price", F.col("price") + F.col("id"))
    many.repartition(12).write.partitionBy("county").parquet(source)
    sinks.compact(spark, source, target, ["county"])
    assert len(files(source)) > 20 and len(files(target)) <= 12
    assert rows(readers.read_layer(spark, target).select(*many.columns)) == rows(many)
    bounded = str(tmp_path / "bounded")
    sinks.compact(spark, source, bounded, max_records_per_file=100)
    assert len(files(bounded)) >= 10


def test_gather_is_a_rebalance(sales):
    assert "REBALANCE" in plan(sinks.gather(sales, ["county"])).upper()


def test_partition_and_column_pruning(spark, sales, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_refined(sales, path)
    stored = readers.read_layer(spark, path, schema=sales.schema)
    text = plan(stored.filter(F.col("county") == "Nyeri").select("quantity"))
    assert "PartitionFilters: [isnotnull(county" in text
    assert "ReadSchema: struct<quantity:int>" in text
    recent = insights.monthly_revenue(stored, 6, datetime.date(2023, 7, 1))
    assert "date" in plan(recent).split("PartitionFilters")[1][:80]


def test_catalog_tables(spark, sales, tmp_path):
    location = str(tmp_path / "ext")
    sinks.write_layer(sales, location, ["county"])
    sinks.create_external_table(spark, "sales_ext", location, sales, ["county"])
    assert readers.read_table(spark, "sales_ext").count() == 5
    sinks.create_external_table(spark, "sales_ext", location, sales, ["county"])
    sinks.create_table(sales, "sales_managed", ["county"])
    sinks.insert_partitions(sales, "sales_managed", ["county"])
    assert rows(spark.table("sales_managed").select(*sales.columns)) == rows(sales)
    kitui = sales.filter("county = 'Kitui'").withColumn("quantity", F.lit(9))
    sinks.insert_partitions(kitui, "sales_managed", ["county"], overwrite=True)
    assert spark.table("sales_managed").count() == 5
    assert spark.table("sales_managed").filter("county = 'Kitui'").first().quantity == 9
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    sinks.create_table(sales, "sales_plain")
    sales.write.insertInto("sales_plain")
    sinks.create_table_as(curated.sales_by_county(sales, ordered=False), "by_county", ["county"])
    assert spark.table("by_county").count() == 3


def test_bucketed_join_does_not_shuffle(spark, sales, products):
    sinks.write_bucketed(sales, "b_sales", ["county"], ["product_id"], 4)
    sinks.write_bucketed(products, "b_products", [], ["product_id"], 4)
    joined = spark.table("b_sales").hint("merge").join(spark.table("b_products"), "product_id")
    assert "Exchange" not in plan(joined)
    assert joined.count() == 5
    assert sinks.BUCKETED_LAYOUTS["sales_data"][2] == 50


def test_layouts_are_applied_by_size(spark, sales, products):
    dated = sales.withColumns({"year": F.year("date"), "month": F.month("date")})
    assert sinks.write_layout(dated, "l_sales", "sales_data", least_rows=0) == ["year", "month", "county"]
    assert sinks.write_layout(dated, "l_whole", "sales_data") == []
    sub = products.withColumn("subcategory", F.col("category"))
    sinks.write_layout(sub, "l_products", "product_data", least_rows=0)
    stored = spark.table("l_sales")
    assert sorted(rows(stored.select(*dated.columns)), key=str) == sorted(rows(dated), key=str)
    assert "Exchange" not in plan(stored.groupBy("product_id").count())
    setting = "spark.sql.bucketing.coalesceBucketsInJoin.enabled"
    spark.conf.set(setting, "true")  # 50 buckets are read as the 25 of the other side
    try:
        joined = stored.hint("merge").join(spark.table("l_products"), "product_id")
        assert "Exchange" not in plan(joined)
        assert joined.count() == dated.join(sub, "product_id").count()
    finally:
        spark.conf.unset(setting)


def test_csv_export(spark, sales, tmp_path):
    path = str(tmp_path / "out")
    sinks.export_csv(sales, path)
    assert readers.read_csv(spark, path, sales.schema).exceptAll(sales).count() == 0


def test_reports_in_sql_equal_the_functions(spark, sales, products):
    view = curated.comprehensive_view(sales, products)
    readers.register_views({"comprehensive_view": view})
    assert rows(spark.sql(insights_sql.TOP_COUNTIES)) == rows(insights.top_counties(view))
    share = rows(spark.sql(insights_sql.REVENUE_SHARE))
    assert share == rows(insights.revenue_share(view))
    assert rows(spark.sql(insights_sql.QUALITY_ISSUES)) == rows(insights.quality_issues(view))
    assert {r[0]: r[4] for r in share if r[0] == "Nyeri"} == {"Nyeri": 100.0}


def test_drill_down_filters_before_the_aggregate(sales, products):
    text = plan(insights.county_drill_down(curated.comprehensive_view(sales, products, ordered=False), "Nyeri"))
    assert "TakeOrderedAndProject" in text
    assert text.rindex("Filter") > text.rindex("HashAggregate")


def test_scratch_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    path = session.scratch_path(spark, "x")
    assert path.startswith(shared) and path != session.scratch_path(spark, "x")
    stored = session.materialize(spark.range(3), "ids")
    assert stored.count() == 3 and os.path.basename(shared) in stored.inputFiles()[0]
