"""Counts of different values that roll up: sketches of bounded size, stored with other sums and merged to any grain.

An exact distinct count can't be put together from those of its parts; a sketch can. Exact counts stay
the default of the curated tables and reports; sketches are for totals that are asked for at many grains.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: A sketch has 2**LOG_SIZE registers; its estimate has a standard error of about 1.04 / sqrt(2**LOG_SIZE).
LOG_SIZE = 12


def standard_error(log_size: int = LOG_SIZE) -> float:
    return 1.04 / 2 ** (log_size / 2)


def distinct_sketches(df: DataFrame, keys: Sequence[str], columns: Sequence[str], log_size: int = LOG_SIZE) -> DataFrame:
    """One sketch for each group and column, named after the column; nulls are not counted."""
    return df.groupBy(*keys).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), log_size).alias(c) for c in columns])


def merge_sketches(sketches: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The sketches of a coarser grain."""
    return sketches.groupBy(*keys).agg(*[F.hll_union_agg(c).alias(c) for c in columns])


def sketch_counts(sketches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The estimated counts in place of the sketches."""
    return sketches.withColumns({c: F.hll_sketch_estimate(c) for c in columns})
