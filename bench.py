"""Seconds per headline query, as one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once and then ``BENCH_RUNS`` times more, unless the first run took over
``LONG_RUN`` seconds; the fastest run counts. The result is computed in full and discarded,
so no time goes into moving rows to Python.
"""

from __future__ import annotations

import json
import os
import time

from shelfwise.checks.queries import QUERIES
from shelfwise.plans import curate, refine
from shelfwise.session import get_session, scratch_path
from shelfwise.sources import sinks, star_schema

HEADLINE = [
    "scan_refined", "csv_with_schema", "partitioned_write", "curated_write", "compacted_write",
    "clean_sales", "refine_dirty", "enrich_county", "join_sales_products", "join_three_keys", "asof_latest",
    "sales_by_product", "sales_by_county", "sales_by_category", "county_product_sales", "comprehensive_view",
    "top_items_per_county", "distinct_counts", "quality_checks", "profile_nulls", "duplicate_count",
    *[f"insight_{n:02d}" for n in range(1, 17)],
    "features", "features_by_group", "forecast_frame", "forecast_accuracy", "demand_trend", "inventory",
    "rfm", "kmeans_profile", "tumbling_window_batch", "stream_window", "audit_summary", "schema_changes",
    "encrypt_round_trip",
]


LONG_RUN = 15
JOBS = ["job_refine", "job_curate"]


def raw_files(spark, root: str) -> str:
    """The sales and products of the tables as CSV below one folder, for the refine job."""
    path = scratch_path(spark, "bench-raw")
    sinks.export_csv(star_schema.raw_sales(spark, root), f"{path}/sales")
    sinks.export_csv(star_schema.raw_products(spark, root), f"{path}/products")
    return path


def run(spark, root: str, name: str, raw: str | None = None) -> float:
    refined = f"{raw}/refined"
    start = time.perf_counter()
    if name == "job_refine":
        refine.run_refine(spark, raw, refined, partition_cols=["county"], price_type=star_schema.PRICE_TYPE)
    elif name == "job_curate":
        curate.run_curate(spark, refined, f"{raw}/curated")
    else:
        QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", ",".join(JOBS + HEADLINE)).split(",")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    raw = raw_files(spark, root) if set(names) & set(JOBS) else None
    seconds = {}
    for name in names:
        timed = [run(spark, root, name, raw)]
        if timed[0] < LONG_RUN:
            timed += [run(spark, root, name, raw) for _ in range(runs)]
        seconds[name] = round(min(timed), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
