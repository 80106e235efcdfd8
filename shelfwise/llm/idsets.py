"""A fixed-size filter for rows whose id may be in a set, to move only those rows in a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of the filter: 2 MB, whatever the size of the set.
FILTER_BITS = 1 << 24


def _slot(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def mark_possible(df: DataFrame, key: str, ids: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``df`` with a boolean column ``possible``: false only if df[key] is null or none of ``ids`` (one column).

    The ids are hashed into bitmaps of ``bits`` bits in total, which are broadcast; a set too large
    for that size only leaves more rows marked as possible.
    """
    slot = _slot(F.col(ids.columns[0]), bits)
    bitmaps = ids.groupBy(F.bitmap_bucket_number(slot).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits")
    )
    slot = _slot(F.col(key), bits)
    position = F.bitmap_bit_position(slot).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, position % 8).bitwiseAND(1)
    return (
        df.withColumn("_bucket", F.bitmap_bucket_number(slot))
        .join(F.broadcast(bitmaps), "_bucket", "left")
        .withColumn("possible", F.coalesce(F.col(key).isNotNull() & (bit == 1), F.lit(False)))
        .drop("_bucket", "_bits")
    )


def without_ids(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key is not one of ``ids``; rows with a null key stay.

    Only rows that the filter marks take part in the anti-join.
    """
    # the columns travel as one, so that no name of theirs is a helper's
    packed = df.select(F.col(f"`{key}`").alias("_key"), F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"))
    marked = mark_possible(packed, "_key", ids)
    named = ids.select(F.col(ids.columns[0]).alias("_id"))
    unsure = marked.filter("possible").join(named, F.col("_key") == F.col("_id"), "left_anti")
    kept = marked.filter("not possible").union(unsure)
    return kept.select(*(F.col("_row").getField(c).alias(c) for c in df.columns))
