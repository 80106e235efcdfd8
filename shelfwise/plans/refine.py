"""Raw to refined: clean, join, write, then check and log what was written."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shelfwise.operators import audit, quality
from shelfwise.operators.cleaning import clean_products, clean_sales
from shelfwise.operators.curated import step_counts
from shelfwise.operators.joins import join_products
from shelfwise.session import scratch_path
from shelfwise.sources import readers, sinks


class QualityError(ValueError):
    """A quality check failed in strict mode."""


@dataclass
class RefineResult:
    path: str
    checks: list
    passed: bool
    row_counts: dict[str, int]


def refine(raw_sales: DataFrame, raw_products: DataFrame, price_type: str = "float") -> DataFrame:
    """Cleaned sales with their product columns."""
    return join_products(clean_sales(raw_sales, price_type), clean_products(raw_products))


def run_refine(
    spark: SparkSession,
    raw_root: str,
    refined_path: str,
    audit_path: str | None = None,
    partition_cols: Sequence[str] = sinks.REFINED_LAYOUT,
    price_type: str = "float",
    min_rows: int = 1000,
    strict: bool = False,
    count_raw: bool = True,
) -> RefineResult:
    """Refine the raw files below ``raw_root``.

    The raw files are read once for the write and, unless ``count_raw`` is off, once for their
    row counts. The checks read a few columns of the written table; none of these numbers
    changes if tasks run twice. A failed check is reported;
    in strict mode the table is first written to the scratch folder, and ``refined_path`` is
    left alone unless the checks pass. With ``audit_path`` a run that raises leaves a FAILED record.
    """
    steps = ["fill missing values", "cast price and quantity", "drop negative values", "join products"]
    inputs = [f"{raw_root}/sales", f"{raw_root}/products"]
    runs = f"{audit_path}/runs" if audit_path else None
    with audit.recorded_run(spark, runs, "refine", inputs, refined_path, steps) as counts:
        raw_sales, raw_products = readers.read_raw(spark, raw_root)
        refined = refine(raw_sales, raw_products, price_type)
        if strict:
            staged = scratch_path(spark, "refined")
            refined.write.parquet(staged)
            refined = spark.read.schema(refined.schema).parquet(staged)
            _raise_if_failed(refined, min_rows)
        sinks.write_refined(refined, refined_path, partition_cols)

        written = readers.read_layer(spark, refined_path, schema=refined.schema)
        checks = quality.quality_checks(written, min_rows)
        check_rows = checks.collect()
        if count_raw:
            raw_counts = step_counts({"sales_raw": raw_sales, "products_raw": raw_products})
            counts.update((row.step, row.row_count) for row in raw_counts.collect())
        counts["joined"] = next(row.actual for row in check_rows if row.check == quality.ROW_COUNT)
        if audit_path:
            stored = spark.createDataFrame(check_rows, checks.schema)
            audit.append_audit(audit.quality_record(stored, "refine"), f"{audit_path}/quality")
    return RefineResult(refined_path, check_rows, all(row.passed for row in check_rows), dict(counts))


def _raise_if_failed(df: DataFrame, min_rows: int) -> None:
    failed = [row.check for row in quality.quality_checks(df, min_rows).collect() if not row.passed]
    if failed:
        raise QualityError("failed checks: " + ", ".join(failed))
