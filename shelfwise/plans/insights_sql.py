"""Reports as Spark SQL over a view or catalog table named ``comprehensive_view``.

For those who query the lake in SQL: register the curated tables (``register_views`` or
``create_external_table``) and pass any of these to ``spark.sql``. Reports on totals are built from
their definition: the grouping, the measures, the order, and how many rows are wanted.
"""

from __future__ import annotations

from collections.abc import Sequence

VIEW = "comprehensive_view"
MEASURES = {
    "total_revenue": "CAST(sum(total_revenue) AS DOUBLE)",
    "total_quantity": "sum(total_quantity)",
    "product_count": "count(*)",
}


def share(measure: str, within: Sequence[str], places: int = 2) -> str:
    """A group's percentage of ``measure`` among the groups that agree in ``within``; null of nothing."""
    value = MEASURES[measure]
    whole = f"sum({value}) OVER (PARTITION BY {', '.join(within)})"
    return f"round(try_divide(100 * {value}, {whole}), {places})"


def totals(
    by: Sequence[str],
    measures: Sequence[str],
    order: Sequence[str],
    limit: int | None = None,
    extra: dict[str, str] | None = None,
) -> str:
    """The text of a report on totals by some columns of the view; ``extra`` has more columns by name."""
    columns = {**{name: MEASURES[name] for name in measures}, **(extra or {})}
    shown = [*by, *(f"{text} AS {name}" for name, text in columns.items())]
    lines = [f"SELECT {', '.join(shown)}", f"FROM {VIEW}", f"GROUP BY {', '.join(by)}", f"ORDER BY {', '.join(order)}"]
    return "\n".join([*lines, f"LIMIT {limit}"] if limit else lines)


TOTALS = ("total_revenue", "total_quantity")
TOP_COUNTIES = totals(["county"], [*TOTALS, "product_count"], ["total_revenue DESC", "county"], 10)
REVENUE_SHARE = totals(
    ["county", "category"], TOTALS, ["county", "total_revenue DESC"],
    extra={"revenue_percentage_by_county": share("total_revenue", ["county"])},
)

QUALITY_ISSUES = """
SELECT stack(3,
         'Negative revenue', count_if(total_revenue < 0),
         'Zero quantity', count_if(total_quantity = 0),
         'Null product names', count_if(coalesce(product_name, '') = '')
       ) AS (issue_type, issue_count)
FROM comprehensive_view
"""
