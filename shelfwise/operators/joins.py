"""Joins of sales with products, of forecasts with actuals, and series lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.functions.calendar import latest_day

# Bits of the filter ahead of a join: half a million words at the most, some 20 MB, whatever the size of the tables.
FILTER_BITS = 1 << 25


def _product_side(sales: DataFrame, products: DataFrame, key: str) -> DataFrame:
    """Products without the columns that sales already has: the sales value wins."""
    keep = [c for c in products.columns if c != key and c not in sales.columns]
    return products.select(F.col(key).cast("string").alias(key), *keep)


def join_products(sales: DataFrame, products: DataFrame, key: str = "product_id") -> DataFrame:
    """Every sale with its product columns, null where the product is unknown.

    A product listed twice doubles its sales, as a left join does. The size of the product
    side decides between a broadcast and a shuffle join.
    """
    left = sales.withColumn(key, F.col(key).cast("string"))
    return left.join(_product_side(sales, products, key), key, "left")


def join_known_products(
    sales: DataFrame, products: DataFrame, where: Column | None = None, key: str = "product_id"
) -> DataFrame:
    """The sales whose product is known, filtered by ``where`` ahead of the join."""
    left = sales.withColumn(key, F.col(key).cast("string"))
    joined = left.join(_product_side(sales, products, key), key, "inner")
    return joined if where is None else joined.filter(where)


def match_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on equal keys; right columns that the left also has are left out."""
    keep = [c for c in right.columns if c in keys or c not in left.columns]
    return left.join(right.select(*keep), list(keys), "inner")


def may_match(left: DataFrame, right: DataFrame, keys: Sequence[str], bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``left`` whose keys may be among those of ``right``: all that an inner join on the keys needs, and few more.

    Use it where most left rows match nothing and would be dealt out only to be dropped. The keys of the right rows mark
    ``bits`` bits, which are broadcast as words of 64; so many right rows that all are marked only let every row through.
    Both sides must have the keys in the same types.
    """
    slot = F.pmod(F.xxhash64(*(F.col(f"`{k}`") for k in keys)), F.lit(bits).cast("long"))
    place = (F.col("_slot") % 64).cast("int")
    marks = right.select(slot.alias("_slot")).groupBy(F.shiftright("_slot", 6).alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place)).alias("_marks")
    )
    marked = left.withColumn("_slot", slot).withColumn("_word", F.shiftright("_slot", 6)).join(F.broadcast(marks), "_word")
    possible = F.call_function("shiftright", F.col("_marks"), place).bitwiseAND(1) == 1
    return marked.filter(possible).select(*(F.col(f"`{c}`") for c in left.columns))


def latest_per_series(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    date: str = "date",
    before: Column | None = None,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The last row of each series, strictly before a date if one is given.

    One hash aggregation with map-side combine: no series is sorted or held in one task.
    Without ``tie_break`` a series must have one row per date, as a daily series has; with it
    rows of one date are ordered by these columns, then by the values.
    """
    if before is not None:
        df = df.filter(F.col(date) < before)
    if tie_break is None:
        return df.groupBy(*keys).agg(
            F.max(date).alias(date), *[F.max_by(v, date).alias(v) for v in values]
        )
    last = df.groupBy(*keys).agg(F.max(F.struct(date, *tie_break, *values)).alias("last"))
    return last.select(*keys, F.col(f"last.{date}").alias(date), *[F.col(f"last.{v}").alias(v) for v in values])


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    date: str = "date",
    strict: bool = False,
    range_of: Column | None = None,
    found: str = "found_date",
) -> DataFrame:
    """Every left row with the values of the last right row of its series up to its own date.

    ``strict`` takes earlier dates only. Of right rows with equal dates the one with the largest values
    (in their order) counts. A left row without an earlier right row, or with a null key or date, has
    nulls; right rows with a null date are never found. ``found`` names the date of what was found.

    Both sides are one table that is dealt by series and sorted by date once; the last right row is
    carried along. ``range_of`` (of the date column, rising with it: its year, say) also deals a series by
    ranges of dates, so that a series which is much of a table isn't one task. What a range begins with
    then comes from one row for each series and range.
    """
    by = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    span = F.lit(0) if range_of is None else range_of
    kept = F.struct(*(F.col(f"`{c}`") for c in left.columns)).alias("_left")
    carried = F.struct(F.col(date).alias("d"), *(F.col(v).alias(f"v{i}") for i, v in enumerate(values))).alias("_right")
    lefts = left.select(*by, F.col(date).alias("_d"), span.alias("_r"), kept)
    rights = right.filter(F.col(date).isNotNull()).select(*by, F.col(date).alias("_d"), span.alias("_r"), carried)
    # at one date right rows stand before the left ones that may find them, the largest values last
    side = F.lit(2) if strict else F.lit(0)
    events = lefts.withColumn("_side", F.lit(1)).unionByName(rights.withColumn("_side", side), allowMissingColumns=True)
    if range_of is not None:
        last = rights.groupBy(*names, "_r").agg(F.max("_right").alias("_last"))
        # an empty range begins with nothing of its own: every range with left rows needs a row here
        ranges = last.unionByName(lefts.select(*names, "_r").distinct(), allowMissingColumns=True).groupBy(*names, "_r").agg(F.max("_last").alias("_last"))
        before = Window.partitionBy(*names).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
        begun = ranges.withColumn("_right", F.last("_last", ignorenulls=True).over(before)).filter("_right is not null")
        events = events.unionByName(begun.select(*names, "_r", F.col("_right.d").alias("_d"), "_right", F.lit(-1).alias("_side")), allowMissingColumns=True)
    order = Window.partitionBy(*names, "_r").orderBy(F.col("_d").asc_nulls_first(), "_side", "_right")
    reached = events.withColumn("_found", F.last("_right", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    known = F.col("_d").isNotNull()
    for name in names:
        known = known & F.col(name).isNotNull()
    return reached.filter("_left is not null").select(
        *(F.col("_left").getField(c).alias(c) for c in left.columns),
        F.when(known, F.col("_found.d")).alias(found),
        *(F.when(known, F.col(f"_found.v{i}")).alias(v) for i, v in enumerate(values)),
    )


def future_days(
    df: DataFrame, keys: Sequence[str], days: int, date: str = "date", last_day: Column | None = None
) -> DataFrame:
    """Each series once for each of the ``days`` days after ``last_day``, by default that of the table."""
    last_day = latest_day(df, date) if last_day is None else last_day
    return with_future_days(df.select(*keys).distinct(), last_day, days, date)


def with_future_days(df: DataFrame, last: Column, days: int, date: str = "date") -> DataFrame:
    """Each row once for each of the ``days`` days after ``last``."""
    ahead = df.withColumn("_ahead", F.explode(F.sequence(F.lit(1), F.lit(days))))
    return ahead.withColumn(date, F.date_add(last, F.col("_ahead"))).drop("_ahead")
