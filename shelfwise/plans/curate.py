"""Refined to curated: one pass over the sales feeds all five curated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.operators import audit, curated
from shelfwise.operators.ranking import rank_items
from shelfwise.session import materialize
from shelfwise.sources import readers, sinks


def curated_tables(sums: DataFrame, money: str | None = "double", ordered: bool = False) -> dict[str, DataFrame]:
    """The five tables from sums by county, category and product.

    They are unsorted unless asked for: a partitioned write does not keep a global order. The sums
    already have one row per county and product, so the ranking takes them as they are.
    """
    return {
        "sales_by_product": curated.finish_by_product(curated.roll_up(sums, curated.BY_PRODUCT), money),
        "sales_by_county": curated.finish_by_county(curated.roll_up(sums, ["county"]), money),
        "sales_by_category": curated.finish_by_category(curated.roll_up(sums, ["category"]), money),
        "top_items_per_county": rank_items(
            curated.finish_by_county_product(sums, money=None), ordered=ordered, money=money
        ),
        "comprehensive_view": curated.finish_comprehensive(sums, money),
    }


def curated_sums(sales: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Sums at the grain of the comprehensive view, which the other tables roll up."""
    return curated.sums_with_products(sales, products, curated.BY_ALL)


def run_curate(
    spark: SparkSession, refined_path: str, curated_root: str, audit_path: str | None = None
) -> dict[str, str]:
    """Write the curated tables; gives the path of each.

    The sums are stored once in the shared folder, so each of the five writes reads a small
    table instead of the refined layer. Metrics come from what was written. With ``audit_path`` a run that
    raises leaves a FAILED record.
    """
    steps = [f"aggregate {name}" for name in sinks.CURATED_LAYOUT]
    runs = f"{audit_path}/runs" if audit_path else None
    with audit.recorded_run(spark, runs, "curate", [refined_path], curated_root, steps) as metrics:
        refined = readers.read_refined(spark, refined_path)
        sums = materialize(curated_sums(refined), "curated-sums")
        paths = sinks.write_curated(curated_tables(sums), curated_root)
        for name, path in paths.items() if audit_path else ():
            row = curated.aggregate_metrics(readers.read_layer(spark, path)).first()
            metrics.update({f"{name}.{key}": value for key, value in row.asDict().items()})
    return paths
