"""The registered queries: each operator over the whole star-schema tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfwise.functions.calendar import is_weekend, latest_day, within_last_months
from shelfwise.functions.measures import revenue
from shelfwise.operators import audit, cleaning, curated, demand, enrichment, joins, protection, quality
from shelfwise.operators import ranking, segments, series, sketches
from shelfwise.plans import curate, encoding, forecasting, insights, insights_sql, refine
from shelfwise.session import materialize, scratch_path
from shelfwise.sources import readers, sinks, star_schema as star
from shelfwise.streaming import windows

Query = Callable[[SparkSession, str], DataFrame]

COUNTY = "NATION_7"
SINCE = "2000-01-01"
GROUP_SERIES = ("category", "county")
PARTITION_ROWS = 200
FILE_BYTES = 1 << 20
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text and decimals as doubles, to compare with another engine."""
    columns = []
    for name, dtype in df.dtypes:
        column = F.col(f"`{name}`")
        if dtype == "date" or dtype.startswith("timestamp"):
            column = column.cast("string")
        elif dtype.startswith("decimal") or dtype == "float":
            column = column.cast("double")
        columns.append(column.alias(name))
    return df.select(*columns)


def _refined(spark: SparkSession, root: str, county: bool = True) -> DataFrame:
    return joins.join_products(star.sales(spark, root, county), star.products(spark, root))


def _view(spark: SparkSession, root: str) -> DataFrame:
    return curated.comprehensive_view(
        star.sales(spark, root), star.products(spark, root), ordered=False, money=None
    )


def _by_product(spark: SparkSession, root: str) -> DataFrame:
    sales = star.sales(spark, root, county=False)
    return curated.sales_by_product(sales, star.products(spark, root), ordered=False, money=None)


def _by_county(spark: SparkSession, root: str) -> DataFrame:
    return curated.sales_by_county(star.sales(spark, root), ordered=False, money=None)


def _last_day(spark: SparkSession, root: str):
    """The last sale day as a literal, from a scan of one column: a bound that scans push down."""
    sales = star.sales(spark, root, county=False)
    return F.lit(sales.agg(F.max("date")).first()[0]).cast("date")


def _table_name() -> str:
    return f"shelfwise_{uuid.uuid4().hex}"


# scans and sinks


@query
def scan_refined(spark, root):
    """A stored refined table, read by path."""
    stored = materialize(_refined(spark, root), "refined")
    return plain(stored)


@query
def catalog_view(spark, root):
    """Registered views joined in SQL."""
    readers.register_views({"sales": star.sales(spark, root), "products": star.products(spark, root)})
    return plain(
        spark.sql(
            """
            SELECT s.county, p.category, COUNT(*) AS sales_count,
                   CAST(SUM(s.price * s.quantity) AS DOUBLE) AS total_revenue
            FROM sales s JOIN products p ON s.product_id = p.product_id
            GROUP BY s.county, p.category
            """
        )
    )


@query
def csv_round_trip(spark, root):
    """Raw sales exported as CSV, scanned again with a schema, cleaned and counted."""
    path = scratch_path(spark, "raw-csv")
    sinks.export_csv(star.raw_sales(spark, root), path)
    cleaned = cleaning.clean_sales(readers.read_csv(spark, path), star.PRICE_TYPE)
    return plain(insights.county_sales(cleaned))


@query
def csv_with_schema(spark, root):
    """As above without inference; blank text comes back as null."""
    path = scratch_path(spark, "raw-csv")
    sinks.export_csv(star.raw_sales(spark, root), path)
    raw = readers.read_csv(spark, path, star.raw_sales(spark, root).schema)
    cleaned = cleaning.clean_sales(raw, star.PRICE_TYPE)
    return plain(insights.county_sales(cleaned))


@query
def partitioned_write(spark, root):
    """Refined rows written by the finest dates whose partitions are large enough, and county; all read back."""
    path = scratch_path(spark, "refined-by-size")
    refined = _refined(spark, root)
    sinks.write_refined_by_size(refined, path, least_rows=PARTITION_ROWS)
    return plain(readers.read_layer(spark, path, schema=refined.schema).select(refined.columns))


@query
def curated_write(spark, root):
    """The five curated tables written from one pass; the totals of each read back."""
    sums = materialize(
        curate.curated_sums(star.sales(spark, root), star.products(spark, root)), "curated-sums"
    )
    paths = sinks.write_curated(curate.curated_tables(sums), scratch_path(spark, "curated"))
    result = None
    for name, path in paths.items():
        rows = readers.read_layer(spark, path).agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("total_quantity").alias("total_quantity"),
            F.sum(F.round("total_revenue", 2).cast("decimal(28,2)")).cast("double").alias("total_revenue"),
        ).select(F.lit(name).alias("table_name"), "row_count", "total_quantity", "total_revenue")
        result = rows if result is None else result.unionByName(rows)
    return result


@query
def compacted_write(spark, root):
    """Sales by county as each task wrote them, compacted, and read back."""
    scattered, compacted = scratch_path(spark, "scattered"), scratch_path(spark, "compacted")
    star.sales(spark, root).write.partitionBy("county").parquet(scattered)
    sinks.compact(spark, scattered, compacted, ["county"])
    return plain(insights.county_sales(readers.read_layer(spark, compacted)))


@query
def compacted_in_place(spark, root):
    """Sales by county in one large file each, and as many small ones as tasks wrote; only the small ones are packed."""
    path = scratch_path(spark, "grown")
    sales = star.sales(spark, root)
    sinks.write_layer(sales, path, ["county"])
    sales.withColumn("quantity", F.lit(1)).repartition(16).write.mode("append").partitionBy("county").parquet(path)
    sinks.compact_small(spark, path, FILE_BYTES, ["county"], sales.schema)
    return plain(insights.county_sales(readers.read_layer(spark, path, schema=sales.schema)))


@query
def rejected_rows(spark, root):
    """Raw sales scanned with their types: rows that fit, and rows rejected, by reason."""
    path = scratch_path(spark, "raw-csv")
    raw = star.raw_sales(spark, root, county=False)
    sinks.export_csv(raw, path)
    schema = "product_id string, date date, quantity int, price decimal(12,2)"
    rows = readers.read_csv(spark, path, T.StructType.fromDDL(schema), keep_corrupt=True)
    good, rejected = readers.split_rejected(rows, ("product_id", "quantity", "price"))
    kept = good.agg(F.lit("kept").alias("reason"), F.count(F.lit(1)).alias("row_count"))
    return kept.unionByName(rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("row_count")))


@query
def external_table(spark, root):
    """A catalog table over files partitioned by county, with its partitions recovered."""
    path, name = scratch_path(spark, "external"), _table_name()
    sales = star.sales(spark, root)
    sinks.write_layer(sales, path, ["county"])
    sinks.create_external_table(spark, name, path, sales, ["county"])
    return plain(insights.county_sales(readers.read_table(spark, name)))


@query
def partition_insert(spark, root):
    """Rows inserted into a partitioned table; a reload of one county replaces that county alone."""
    name = _table_name()
    sales = star.sales(spark, root)
    sinks.create_table(sales, name, ["county"], location=scratch_path(spark, "inserted"))
    sinks.insert_partitions(sales, name, ["county"])
    reload = sales.filter(F.col("county") == COUNTY).withColumn("quantity", F.col("quantity") + 1)
    sinks.insert_partitions(reload, name, ["county"], overwrite=True)
    return plain(insights.county_sales(readers.read_table(spark, name)))


@query
def table_as_query(spark, root):
    """A query result stored as a table."""
    name = _table_name()
    by_county = curated.sales_by_county(star.sales(spark, root), ordered=False)
    sinks.create_table_as(by_county, name, location=scratch_path(spark, "stored-query"))
    return plain(readers.read_table(spark, name))


@query
def bucketed_join(spark, root):
    """Daily sums and products bucketed by product: their join moves no rows.

    Daily sums and not single sales, so that the bucket of a much-sold product stays small.
    """
    daily, products = _table_name(), _table_name()
    buckets = 8
    sums = series.daily_series(star.sales(spark, root, county=False), ["product_id"])
    sinks.write_bucketed(sums, daily, [], ["product_id"], buckets, scratch_path(spark, "bucketed-sales"))
    sinks.write_bucketed(
        star.products(spark, root), products, [], ["product_id"], buckets, scratch_path(spark, "bucketed-products")
    )
    joined = joins.join_products(readers.read_table(spark, daily), readers.read_table(spark, products))
    return joined.groupBy("category").agg(
        F.sum("revenue").cast("double").alias("total_revenue"),
        F.sum("quantity").alias("total_quantity"),
        F.count(F.lit(1)).alias("product_days"),
    )


@query
def bucketed_layouts(spark, root):
    """Each of the three layouts written whole and read back by its bucket column, which moves no rows."""
    parts = star.table(spark, root, "part").select(F.col("p_partkey").cast("string").alias("product_id"), F.col("p_brand").alias("subcategory"))
    sales = star.sales(spark, root).withColumns({"year": F.year("date"), "month": F.month("date")})
    tables = {
        "sales_data": (sales, F.sum("quantity").cast("double")),
        "customer_data": (star.customers(spark, root), F.sum("amount").cast("double")),
        "product_data": (star.products(spark, root).join(parts, "product_id"), F.count_distinct("category", "subcategory").cast("double")),
    }
    found = None
    for layout, (df, measure) in tables.items():
        name = _table_name()
        sinks.write_layout(df, name, layout, scratch_path(spark, layout), least_rows=PARTITION_ROWS)
        by_key = readers.read_table(spark, name).groupBy(*sinks.BUCKETED_LAYOUTS[layout][1]).agg(F.count(F.lit(1)).alias("n"), measure.alias("total"))
        row = by_key.agg(
            F.lit(layout).alias("layout"), F.count(F.lit(1)).alias("key_count"), F.sum("n").alias("row_count"), F.round(F.sum("total"), 2).alias("total")
        )
        found = row if found is None else found.union(row)
    return found


# cleaning, projections and filters


@query
def clean_sales(spark, root):
    raw = star.raw_sales(spark, root, extra=("l_orderkey", "l_linenumber"))
    return plain(cleaning.clean_sales(raw))


@query
def clean_products(spark, root):
    return plain(cleaning.clean_products(star.raw_products(spark, root)))


@query
def refine_dirty(spark, root):
    """Cleaned dirty sales with product columns: unknown products keep their nulls."""
    sales = cleaning.clean_sales(star.raw_sales(spark, root, county=False), star.PRICE_TYPE)
    products = cleaning.clean_products(star.raw_products(spark, root))
    return plain(curated.sales_by_product(sales, products, ordered=False))


@query
def filter_county(spark, root):
    return plain(star.sales(spark, root).filter(F.col("county") == COUNTY))


@query
def project_rename(spark, root):
    sales = star.sales(spark, root, county=False)
    return plain(sales.select("product_id", "date", "quantity").withColumnRenamed("quantity", "units"))


@query
def derive_revenue(spark, root):
    sales = star.sales(spark, root, county=False)
    return plain(sales.select("product_id", "date", revenue().alias("revenue")))


@query
def case_weekend(spark, root):
    sales = star.sales(spark, root, county=False)
    days = sales.withColumn("is_weekend", is_weekend(F.col("date")))
    return days.groupBy("is_weekend").agg(
        F.count(F.lit(1)).alias("sales_count"), F.sum("quantity").alias("total_quantity")
    )


@query
def recent_sales(spark, root):
    """The sales of the last six months before the last date."""
    sales = star.sales(spark, root, county=False)
    return plain(sales.filter(within_last_months(F.col("date"), 6, _last_day(spark, root))))


@query
def enrich_county(spark, root):
    """A county drawn by weight for every sale."""
    keys = ("l_orderkey", "l_linenumber", "product_id")
    sales = star.sales(spark, root, county=False, extra=("l_orderkey", "l_linenumber"))
    drawn = enrichment.add_county(sales, keys)
    return plain(insights.county_sales(drawn))


# joins


@query
def join_sales_products(spark, root):
    """Every sale with product columns, unknown products included."""
    sales = star.sales(spark, root, county=False, extra=("l_orderkey", "l_linenumber"))
    return plain(joins.join_products(sales, star.raw_products(spark, root)))


@query
def inner_join_filter(spark, root):
    sales = star.sales(spark, root, county=False)
    known = joins.join_known_products(sales, star.raw_products(spark, root), F.col("category") == "ECONOMY")
    return plain(known)


@query
def join_three_keys(spark, root):
    """Yesterday's quantity as the forecast, joined with the actual quantity and measured."""
    daily = materialize(series.daily_series(star.sales(spark, root)), "daily")
    keys = series.SERIES
    lagged = series.lag_columns("quantity", keys, "date", {"forecast_quantity": 1})
    naive = daily.select("date", *keys, *[c.cast("double").alias(n) for n, c in lagged.items()])
    accuracy = forecasting.forecast_accuracy(daily, naive.filter(F.col("forecast_quantity").isNotNull()))
    return accuracy.select("n", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")])


@query
def future_days(spark, root):
    return plain(joins.future_days(star.sales(spark, root), ["county"], 7, last_day=_last_day(spark, root)))


@query
def asof_latest(spark, root):
    """The last sale day of every product and county strictly before a date."""
    daily = series.daily_series(star.sales(spark, root))
    return plain(
        joins.latest_per_series(daily, series.SERIES, ["quantity", "price"], before=F.lit(SINCE).cast("date"))
    )


@query
def asof_join(spark, root):
    """For every line the last sale of its product that was shipped on an earlier day."""
    lines = star.table(spark, root, "lineitem").select(
        F.col("l_partkey").cast("string").alias("product_id"), F.col("l_shipdate").cast("date").alias("date"), "l_orderkey", "l_linenumber"
    )
    prices = star.sales(spark, root, county=False)
    found = joins.asof_join(lines, prices, ["product_id"], ["price", "quantity"], strict=True, range_of=F.year("date"))
    return plain(found)


# aggregates


@query
def sales_by_product(spark, root):
    return plain(
        curated.sales_by_product(star.sales(spark, root, county=False), star.products(spark, root))
    )


@query
def sales_by_county(spark, root):
    return plain(curated.sales_by_county(star.sales(spark, root)))


@query
def sales_by_category(spark, root):
    return plain(
        curated.sales_by_category(star.sales(spark, root, county=False), star.products(spark, root))
    )


@query
def county_product_sales(spark, root):
    return plain(curated.county_product_sales(star.sales(spark, root), star.products(spark, root)))


@query
def comprehensive_view(spark, root):
    return plain(curated.comprehensive_view(star.sales(spark, root), star.products(spark, root)))


@query
def aggregate_metrics(spark, root):
    return curated.aggregate_metrics(_by_product(spark, root))


@query
def top_items_metrics(spark, root):
    top = ranking.top_items_per_county(star.sales(spark, root), star.products(spark, root), ordered=False)
    return curated.top_items_metrics(top)


@query
def distinct_series(spark, root):
    return star.sales(spark, root).select("product_id", "county").distinct()


@query
def distinct_counts(spark, root):
    """Different products and days by county."""
    return star.sales(spark, root).groupBy("county").agg(
        F.count_distinct("product_id").alias("products"), F.count_distinct("date").alias("days")
    )


@query
def distinct_sketched(spark, root):
    """Products and days counted by sketches stored by county and month and merged, beside exact counts.

    ``near`` says whether the estimate lies within five standard errors of the exact count.
    """
    sales = star.sales(spark, root).withColumns({"month": F.date_format("date", "yyyy-MM"), "all": F.lit("")})
    names = ["product_id", "date"]
    stored = materialize(sketches.distinct_sketches(sales, ["county", "month", "all"], names), "sketches")
    bound = 5 * sketches.standard_error()
    result = None
    for grain in ("county", "month", "all"):
        estimates = sketches.sketch_counts(sketches.merge_sketches(stored, [grain], names), names)
        exact = sales.groupBy(grain).agg(*[F.count_distinct(c).alias(f"exact_{c}") for c in names])
        both = estimates.join(exact, grain)
        near = [F.abs(F.col(c) - F.col(f"exact_{c}")) <= bound * F.col(f"exact_{c}") for c in names]
        rows = both.select(
            F.lit(grain).alias("grain"), F.col(grain).alias("value"),
            F.col("exact_product_id").alias("products"), F.col("exact_date").alias("days"), (near[0] & near[1]).alias("near"),
        )
        result = rows if result is None else result.unionByName(rows)
    return result


@query
def count_non_null(spark, root):
    """Rows, and rows that have a price and a quantity, before cleaning."""
    return star.raw_sales(spark, root).groupBy("county").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("price").alias("price_count"),
        F.count("quantity").alias("quantity_count"),
    )


@query
def max_date(spark, root):
    return plain(star.sales(spark, root, county=False).agg(F.max("date").alias("max_date")))


@query
def step_counts(spark, root):
    """Row counts of raw, cleaned and joined data."""
    raw = star.raw_sales(spark, root, county=False)
    return curated.refine_counts(raw, star.raw_products(spark, root), star.PRICE_TYPE)


# ranking


@query
def top_items_per_county(spark, root):
    return plain(ranking.top_items_per_county(star.sales(spark, root), star.products(spark, root)))


# reports


@query
def insight_01(spark, root):
    return insights.top_counties(_view(spark, root))


@query
def insight_02(spark, root):
    return insights.top_categories(_view(spark, root))


@query
def insight_03(spark, root):
    return insights.top_products(_by_product(spark, root))


@query
def insight_04(spark, root):
    return insights.top_county_categories(_view(spark, root))


@query
def insight_05(spark, root):
    return insights.revenue_share(_view(spark, root))


@query
def insight_06(spark, root):
    return insights.transaction_value(_by_county(spark, root))


@query
def insight_07(spark, root):
    top = ranking.top_items_per_county(
        star.sales(spark, root), star.products(spark, root), ordered=False, money=None
    )
    return insights.top_products_per_county(top)


@query
def insight_08(spark, root):
    return insights.category_performance(_view(spark, root))


@query
def insight_09(spark, root):
    return insights.price_range(_by_product(spark, root))


@query
def insight_10(spark, root):
    return insights.market_penetration(_view(spark, root))


@query
def insight_11(spark, root):
    return plain(insights.monthly_revenue(star.sales(spark, root), as_of=_last_day(spark, root)))


@query
def insight_12(spark, root):
    return insights.county_drill_down(_view(spark, root), COUNTY)


@query
def insight_13(spark, root):
    sales = cleaning.clean_sales(star.raw_sales(spark, root), star.PRICE_TYPE)
    products = cleaning.clean_products(star.raw_products(spark, root))
    return quality.quality_issues(curated.comprehensive_view(sales, products, ordered=False))


@query
def insight_14(spark, root):
    return insights.county_sales(star.sales(spark, root))


@query
def insight_15(spark, root):
    return plain(insights.county_sales_with_names(star.sales(spark, root), star.products(spark, root), COUNTY))


@query
def insight_16(spark, root):
    return insights.county_units_since(star.sales(spark, root), SINCE)


def _sql_report(spark: SparkSession, root: str, text: str) -> DataFrame:
    readers.register_views({"comprehensive_view": _view(spark, root)})
    return plain(spark.sql(text))


@query
def sql_top_counties(spark, root):
    return _sql_report(spark, root, insights_sql.TOP_COUNTIES)


@query
def sql_revenue_share(spark, root):
    return _sql_report(spark, root, insights_sql.REVENUE_SHARE)


@query
def sql_quality_issues(spark, root):
    return _sql_report(spark, root, insights_sql.QUALITY_ISSUES)


# quality and audit


@query
def quality_checks(spark, root):
    """The checks on the dirty sales as they come."""
    return quality.quality_checks(_typed_raw(spark, root))


@query
def quality_verdict(spark, root):
    return quality.quality_verdict(quality.quality_checks(_typed_raw(spark, root)))


def _typed_raw(spark: SparkSession, root: str) -> DataFrame:
    raw = star.raw_sales(spark, root, county=False)
    return raw.withColumn("price", F.col("price").try_cast(star.PRICE_TYPE))


@query
def profile_nulls(spark, root):
    raw = star.raw_sales(spark, root)
    return quality.null_profile(joins.join_products(raw, star.raw_products(spark, root)))


@query
def duplicate_count(spark, root):
    sales = star.sales(spark, root)
    return quality.duplicate_count(sales.select("product_id", "county", "quantity"))


def _field_snapshot(events: DataFrame) -> DataFrame:
    """A snapshot derived from events: a user is a table, an event type and key a field."""
    top = F.max("value")
    key = F.get_json_object("props", "$.k").cast("int") % 4
    kind = F.when(top > 120, "double").when(top > 40, "float").otherwise("int")
    return events.groupBy(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("table_name"),
        F.concat_ws("_", "event_type", key.cast("string")).alias("field"),
    ).agg(kind.alias("type"))


def _snapshots(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    events = star.table(spark, root, "events")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    return _field_snapshot(events.filter(F.col("ts") < middle)), _field_snapshot(events.filter(F.col("ts") >= middle))


@query
def schema_changes(spark, root):
    """Fields lost or of another type in the second half of the month."""
    return audit.breaking_changes(*_snapshots(spark, root))


@query
def schema_compatibility(spark, root):
    return audit.schema_compatibility(*_snapshots(spark, root))


def _audit_lines(spark: SparkSession, root: str) -> DataFrame:
    """Audit records as JSON text, one per event: runs, quality verdicts, and some broken lines."""
    events = star.table(spark, root, "events")
    is_quality = F.col("event_type") == "signup"
    steps = F.transform(
        F.sequence(F.lit(1), 1 + F.get_json_object("props", "$.k").cast("int") % 4),
        lambda i: F.concat(F.lit("step "), i.cast("string")),
    )
    line = F.to_json(
        F.struct(
            F.concat(F.lit("job_"), F.col("user_id").cast("string")).alias("job_name"),
            F.col("ts").cast("string").alias("timestamp"),
            F.when(~is_quality, F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS")).alias("status"),
            F.when(~is_quality, steps).alias("transformations"),
            F.when(is_quality, F.when(F.col("value") < 60, "PASSED").otherwise("FAILED")).alias("overall_status"),
        )
    )
    broken = F.col("event_id") % 97 == 0
    return events.select(F.when(broken, F.substring(line, 1, 20)).otherwise(line).alias("value"))


@query
def audit_summary(spark, root):
    """A week of audit records, written as JSON lines and scanned; broken lines are skipped."""
    path = scratch_path(spark, "audit")
    _audit_lines(spark, root).write.text(path)
    last = star.table(spark, root, "events").agg(F.max("ts")).scalar()
    return audit.audit_summary(readers.read_audit(spark, path, days=7, as_of=last), days=7)


@query
def audit_by_day(spark, root):
    """The same week from records kept in a folder for each day: earlier days are not read."""
    lines, path = scratch_path(spark, "audit"), scratch_path(spark, "audit-days")
    _audit_lines(spark, root).write.text(lines)
    audit.append_audit(readers.read_audit(spark, lines), path, by_day=True)
    last = star.table(spark, root, "events").agg(F.max("ts")).scalar()
    return audit.audit_summary(readers.read_audit(spark, path, days=7, as_of=last, by_day=True), days=7)


@query
def run_records(spark, root):
    """The records of three jobs over the dirty files: refused for too few rows, refined, and curated."""
    path = scratch_path(spark, "jobs")
    sinks.export_csv(star.raw_sales(spark, root), f"{path}/raw/sales")
    sinks.export_csv(star.raw_products(spark, root), f"{path}/raw/products")
    job = {"partition_cols": ["county"], "price_type": star.PRICE_TYPE}
    try:
        refine.run_refine(
            spark, f"{path}/raw", f"{path}/refused", f"{path}/audit", min_rows=1 << 60, strict=True, **job
        )
    except refine.QualityError:
        pass
    refine.run_refine(spark, f"{path}/raw", f"{path}/refined", f"{path}/audit", **job)
    curate.run_curate(spark, f"{path}/refined", f"{path}/curated", f"{path}/audit")
    records = readers.read_audit(spark, f"{path}/audit/runs")
    number = lambda name: F.col("metrics")[name].cast("bigint").alias(name.replace(".", "_"))
    return records.select(
        "job_name", "status", F.size("transformations").alias("steps"),
        F.substring_index(F.col("metrics")["error"], ":", 1).alias("error"),
        number("sales_raw"), number("products_raw"), number("joined"), number("sales_by_county.group_count"),
    )


@query
def quality_record(spark, root):
    """The quality record of the dirty sales, one row per check, with its compliance flags."""
    record = audit.quality_record(quality.quality_checks(_typed_raw(spark, root)), "refine", F.lit("2024-01-31"))
    return record.select(
        "job_name", "quality_type", "overall_status",
        "compliance.data_governance", "compliance.quality_standards", "compliance.audit_required",
        F.explode("checks").alias("check_name", "result"),
    ).select("*", "result.passed", "result.actual", "result.threshold").drop("result")


# series and demand models


@query
def features(spark, root):
    table = series.sales_features(series.daily_series(star.sales(spark, root)))
    stds = [F.round(c, 6).alias(c) for c in series.MOVING_DEVIATIONS]
    others = [c for c in table.columns if c not in series.MOVING_DEVIATIONS]
    return plain(table.select(*others, *stds))


@query
def features_by_group(spark, root):
    """The same over dense series: category and county, moving frames in calendar days."""
    daily = series.daily_series(_refined(spark, root), GROUP_SERIES)
    table = series.sales_features(daily, GROUP_SERIES, by_days=True)
    stds = [F.round(c, 6).alias(c) for c in series.MOVING_DEVIATIONS]
    others = [c for c in table.columns if c not in series.MOVING_DEVIATIONS]
    return plain(table.select(*others, *stds))


@query
def hash_split(spark, root):
    """Rows and quantity on each side of the 80/20 split."""
    daily = series.daily_series(star.sales(spark, root))
    train, test = forecasting.split_rows(daily, ["product_id", "county", "date"])
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return sides.groupBy("side").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("quantity").alias("total_quantity")
    )


@query
def forecast_frame(spark, root):
    daily = series.daily_series(star.sales(spark, root))
    return plain(forecasting.forecast_frame(daily, last_day=_last_day(spark, root)))


def _daily(spark: SparkSession, root: str) -> DataFrame:
    return materialize(series.daily_series(star.sales(spark, root)), "daily")


def _train(daily: DataFrame, **options) -> forecasting.TrainedModels:
    table = materialize(series.sales_features(daily), "features")
    train, test = forecasting.split_rows(table, [*series.SERIES, "date"])
    return forecasting.train_models(train, test, strict=True, **options)


@query
def model_metrics(spark, root):
    trained = _train(_daily(spark, root))
    return forecasting.model_metrics(spark, trained)


@query
def forecast(spark, root):
    """Every product and county on each of the next 30 days, by the best of all models."""
    daily = _daily(spark, root)
    return plain(forecasting.forecast(_train(daily), daily))


@query
def feature_importance(spark, root):
    trained = _train(_daily(spark, root))
    trees = [n for n in trained.metrics if n != "linear_regression"]
    return forecasting.feature_importance(spark, trained, min(trees, key=lambda n: trained.metrics[n]["rmse"]))


@query
def forecast_accuracy(spark, root):
    """Models that do not know the last 30 days, measured on them."""
    daily = _daily(spark, root)
    cut = F.date_sub(_last_day(spark, root), 30)
    known = daily.filter(F.col("date") <= cut)
    trained = _train(known, with_categories=True)
    return forecasting.forecast_accuracy(daily.filter(F.col("date") > cut), forecasting.forecast(trained, known))


@query
def rolling_split(spark, root):
    """Rows and days on each side of three splits by time, 60 days apart."""
    daily = series.daily_series(star.sales(spark, root))
    used = forecasting.rolling_folds(daily, 3, 60, _last_day(spark, root))
    return plain(
        used.groupBy("fold", "side").agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("quantity").alias("total_quantity"), F.min("date").alias("first_day"), F.max("date").alias("last_day")
        )
    )


@query
def category_means(spark, root):
    """Out-of-fold means of quantity by county for each fold of the training rows, and those of the test rows."""
    daily = series.daily_series(star.sales(spark, root))
    keys = [*series.SERIES, "date"]
    train, test = forecasting.split_rows(daily, keys)
    means = encoding.fit_target_means(train, ["county"], "quantity", keys)
    fold = encoding.fold_of(keys)
    rows = means.for_training(train).withColumn("fold", fold).unionByName(means.for_others(test).withColumn("fold", F.lit(-1)))
    return rows.groupBy("county", "fold").agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.min("county_mean"), 6).alias("lowest"), F.round(F.max("county_mean"), 6).alias("highest")
    )


def _proof_rows(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    daily = materialize(series.daily_series(star.sales(spark, root)), "daily")
    rows = daily.select(*series.SERIES, "date", "quantity", F.col("price").cast("double").alias("price"))
    return forecasting.split_rows(rows, [*series.SERIES, "date"])


@query
def fitted_line(spark, root):
    """Least squares of quantity by price, and a fit forced to be flat: their errors on the test rows, and the winner."""
    train, test = _proof_rows(spark, root)
    models = {
        "line": lambda label: LinearRegression(labelCol=label, solver="normal"),
        "flat": lambda label: LinearRegression(labelCol=label, regParam=1e15, solver="normal"),
    }
    trained = forecasting.train_models(train, test, feature_columns=["price"], estimators=models)
    rows = [(n, int(m["n"]), m["rmse"], m["mae"], m["r2"], n == trained.best_name) for n, m in trained.metrics.items()]
    made = spark.createDataFrame(rows, "model string, n long, rmse double, mae double, r2 double, is_best boolean")
    return made.select("model", "n", *[F.round(c, 5).alias(c) for c in ("rmse", "mae", "r2")], "is_best")


def _step_models(spark: SparkSession, root: str, unseen: int = 0) -> tuple[DataFrame, forecasting.TrainedModels]:
    """Daily rows whose quantity is a step, 7 on weekends and 3 on other days, and trees that learn it without the last days."""
    daily = series.daily_series(star.sales(spark, root))
    step = F.when(is_weekend(F.col("date")) == 1, 7).otherwise(3).cast("long")
    daily = materialize(daily.withColumn("quantity", step).filter(F.col("date") <= F.date_sub(_last_day(spark, root), unseen)), "steps")
    table = materialize(series.sales_features(daily), "step-features")
    train, test = forecasting.split_rows(table, [*series.SERIES, "date"])
    names = [n for n in forecasting.ESTIMATORS if n != "linear_regression"]
    return daily, forecasting.train_models(train, test, names=names, feature_columns=["is_weekend", "day_of_month", "month"], strict=True)


@query
def step_forecast(spark, root):
    """Every product and county on the next 14 days, by trees fitted to the step."""
    daily, trained = _step_models(spark, root)
    made = forecasting.forecast(trained, daily, days=14)
    return plain(made.withColumn("forecast_quantity", F.round("forecast_quantity", 6)).select("product_id", "county", "date", "forecast_quantity"))


@query
def step_accuracy(spark, root):
    """Trees that learnt the step without the last 30 days, measured on them against the step raised by product."""
    known, trained = _step_models(spark, root, unseen=30)
    step = F.when(is_weekend(F.col("date")) == 1, 7).otherwise(3)
    raised = step + F.pmod(F.col("product_id").cast("long"), F.lit(3))
    actuals = series.daily_series(star.sales(spark, root)).withColumn("quantity", raised.cast("long"))
    # forecasts begin after the last known day
    unseen = materialize(actuals.filter(F.col("date") > F.date_sub(_last_day(spark, root), 30)), "unseen")
    errors = forecasting.forecast_accuracy(unseen, forecasting.forecast(trained, known))
    return errors.select("n", *[F.round(c, 5).alias(c) for c in ("rmse", "mae", "r2")])


@query
def step_importance(spark, root):
    """What boosted trees fitted to the step say of their features: the weekend alone matters."""
    _, trained = _step_models(spark, root)
    return forecasting.feature_importance(spark, trained, "gradient_boosted").select("feature", F.round("importance", 6).alias("importance"))


@query
def naive_errors(spark, root):
    """Errors of the day before as the forecast, over all series: the measures that choose a model."""
    table = series.sales_features(series.daily_series(star.sales(spark, root)))
    errors = forecasting.error_metrics(table, "quantity", "prev_day_quantity")
    return errors.select("n", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")])


@query
def demand_trend(spark, root):
    daily = series.daily_series(star.sales(spark, root), ["county"])
    trends = demand.forecast_trends(daily, 30, last_day=_last_day(spark, root))
    return plain(trends.withColumn("prediction", F.round("prediction", 6)))


@query
def inventory(spark, root):
    """Stock levels from the daily demand forecast of each county."""
    daily = series.daily_series(star.sales(spark, root), ["county"])
    levels = demand.stock_levels(demand.forecast_trends(daily, 30, last_day=_last_day(spark, root)))
    return levels.select("county", *[F.round(c, 5).alias(c) for c in levels.columns if c != "county"])


@query
def inventory_observed(spark, root):
    """Stock levels from the observed daily demand of each county."""
    daily = series.daily_series(star.sales(spark, root), ["county"])
    levels = demand.stock_levels(daily, value="quantity")
    return levels.select("county", *[F.round(c, 5).alias(c) for c in levels.columns if c != "county"])


# customers


@query
def rfm(spark, root):
    purchases = star.purchases(spark, root)
    return plain(segments.rfm(purchases, latest_day(star.purchases(spark, root))))


@query
def kmeans_profile(spark, root):
    customers = materialize(segments.rfm(star.purchases(spark, root), "2002-01-01"), "customers")
    return segments.segment_profile(segments.fit_segments(customers).transform(customers))


@query
def kmeans_separated(spark, root):
    """Segments of customers moved to three places far apart, which any right fit must tell apart."""
    place = F.col("customer_id") % 3
    customers = segments.rfm(star.purchases(spark, root), "2002-01-01").select(
        "customer_id",
        (F.col("recency") % 30 + place * 1000).alias("recency"),
        (F.col("frequency") + place * 5000).alias("frequency"),
        (F.floor("monetary_value") % 1000 + place * 1000000).alias("monetary_value"),
    )
    customers = materialize(customers, "customers")
    profile = segments.segment_profile(segments.fit_segments(customers, k=3).transform(customers))
    means = [F.round(c, 6).alias(c) for c in ("avg_recency", "avg_frequency", "avg_monetary")]
    return profile.select("customer_count", *means)


# streams


def _sale_events(events: DataFrame) -> DataFrame:
    """Events as JSON payloads of a sale: time, group and amount."""
    return events.select(
        F.to_json(
            F.struct(
                F.col("ts").cast("timestamp").alias("timestamp"),
                F.col("event_type").alias("county"),
                F.round("value", 2).cast("decimal(18,2)").alias("amount"),
            )
        ).alias("value")
    )


def _plain_windows(df: DataFrame) -> DataFrame:
    """Window bounds as text in the session's time zone, as the event times were read."""
    return df.select(
        *[F.col(c).cast("timestamp_ntz").cast("string").alias(c) for c in ("window_start", "window_end")],
        "county",
        "transaction_count",
        F.col("total_sales").cast("double").alias("total_sales"),
    )


@query
def parse_json_events(spark, root):
    parsed = windows.parse_events(_sale_events(star.table(spark, root, "events")))
    return parsed.groupBy("county").agg(
        F.count("timestamp").alias("event_count"), F.sum("amount").cast("double").alias("total_amount")
    )


@query
def tumbling_window_batch(spark, root):
    events = windows.parse_events(_sale_events(star.table(spark, root, "events")))
    return _plain_windows(windows.windowed_sales(events))


@query
def stream_window(spark, root):
    """The same as a stream over files: the windows closed by the watermark."""
    schema = star.table(spark, root, "events").schema
    stream = windows.read_events(spark, "parquet", schema, f"{root}/events*.parquet")
    parsed = windows.parse_events(_sale_events(stream))
    out, state = scratch_path(spark, "windows"), scratch_path(spark, "windows-state")
    aggregated = windows.windowed_sales(parsed)
    running = windows.write_windows(aggregated, out, state, available_now=True)
    running.awaitTermination()
    return _plain_windows(spark.read.schema(aggregated.schema).parquet(out))


def _arrivals(spark: SparkSession, root: str) -> DataFrame:
    """Events with the number of their arrival: ten days each, one event in five coming an arrival later."""
    events = star.table(spark, root, "events")
    first = events.agg(F.min("ts")).scalar()
    tens = F.floor(F.datediff(F.col("ts").cast("date"), first.cast("date")) / 10).cast("int")
    delayed = (F.col("event_id") % 5 == 0).cast("int")
    return events.withColumn("arrival", F.least(F.lit(2), tens + delayed))


@query
def stream_arrivals(spark, root):
    """Windows of a stream stopped and restarted from its checkpoint between three arrivals, and the late events of each."""
    source, state, out, late = (scratch_path(spark, f"arrivals-{name}") for name in ("in", "state", "out", "late"))
    arrivals = materialize(_arrivals(spark, root), "arrivals")
    for number in range(3):
        arrivals.filter(F.col("arrival") == number).drop("arrival").write.mode("append").parquet(source)
        stream = windows.read_events(spark, "parquet", star.table(spark, root, "events").schema, source)
        parsed = windows.parse_events(_sale_events(stream))
        aggregated = windows.windowed_sales(parsed)
        windows.write_windows(aggregated, out, f"{state}/windows", available_now=True).awaitTermination()
        windows.write_late_events(parsed, late, f"{state}/late", available_now=True).awaitTermination()
    kept = windows.late_events(spark, late).select(
        F.window("timestamp", "5 minutes").alias("window"), F.col("county").alias("late_county")
    )
    missed = kept.groupBy("window.start", "late_county").agg(F.count(F.lit(1)).alias("late_count"))
    found = spark.read.schema(aggregated.schema).parquet(out)
    same = (F.col("window_start") == F.col("start")) & (F.col("county") == F.col("late_county"))
    return found.join(missed, same, "full").select(
        F.coalesce("window_start", "start").cast("timestamp_ntz").cast("string").alias("window_start"),
        F.coalesce("county", "late_county").alias("county"),
        "transaction_count",
        F.col("total_sales").cast("double").alias("total_sales"),
        F.coalesce("late_count", F.lit(0)).alias("late_count"),
    )


# protection


@query
def encrypt_round_trip(spark, root):
    """Customer names and balances encrypted, then decrypted again."""
    key = F.unhex(F.lit("000102030405060708090a0b0c0d0e0f"))
    customers = star.table(spark, root, "customer").select("c_custkey", "c_name", "c_acctbal")
    hidden = protection.encrypt_columns(customers, ["c_name", "c_acctbal"], key)
    leaked = F.col("c_name").startswith("Customer#")
    checked = hidden.withColumn("was_hidden", ~leaked)
    return protection.decrypt_columns(checked, {"c_name": "string", "c_acctbal": "double"}, key)
