"""Exact histogram of encoded lengths, with suffix sums for every context limit."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.llm.tokens import RANKS_FILE, Encoder
from shelfwise.session import materialize

_BLOCK_BITS = 8


def length_histogram(documents: DataFrame, ranks_file: str = RANKS_FILE) -> DataFrame:
    """length, documents: how many rows of ``documents`` (text; others unused) have so many tokens. A null text has none."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.load(ranks_file)
        for batch in batches:
            counts = Counter(len(encoder.encode(t.as_py() or "")) for t in batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["length", "documents"])

    return documents.select("text").mapInArrow(task, "length long, documents long").groupBy("length").agg(F.sum("documents").alias("documents"))


def with_suffix_sums(histogram: DataFrame) -> DataFrame:
    """The histogram with what lies at or beyond each length.

    documents_at_least and tokens_at_least are the sums from this length on, truncated_tokens the
    tokens of the corpus if every document is cut to this length, share_at_most the part of the
    documents that fit. Sums are taken within blocks of lengths and then over the blocks, so the
    last step sorts few rows however long the longest text is.
    """
    rows = materialize(histogram.withColumn("block", F.shiftright("length", _BLOCK_BITS)).withColumn("tokens", F.col("length") * F.col("documents")), "lengths")
    beyond = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("block").agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t")).select(
        "block", F.coalesce(F.sum("d").over(beyond), F.lit(0)).alias("d"), F.coalesce(F.sum("t").over(beyond), F.lit(0)).alias("t")
    )
    total = rows.agg(F.sum("documents").alias("all_documents"), F.sum("tokens").alias("all_tokens"))
    within = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumns({"ds": F.sum("documents").over(within), "ts": F.sum("tokens").over(within)})
    return (
        summed.join(blocks, "block")
        .join(F.broadcast(total))  # one row
        .select(
            "length",
            "documents",
            (F.col("ds") + F.col("d")).alias("documents_at_least"),
            (F.col("ts") + F.col("t")).alias("tokens_at_least"),
            (F.col("all_tokens") - F.col("ts") - F.col("t") + F.col("length") * (F.col("ds") + F.col("d"))).alias("truncated_tokens"),
            ((F.col("all_documents") - F.col("ds") - F.col("d") + F.col("documents")) / F.col("all_documents")).alias("share_at_most"),
        )
    )


def at_limit(sums: DataFrame, limit: int) -> dict:
    """documents, tokens and truncated tokens for any context limit, also one that no document has."""
    row = sums.filter(F.col("length") >= limit).orderBy("length").select("documents_at_least", "tokens_at_least").first()
    longer, beyond = (row[0], row[1]) if row else (0, 0)
    tokens = sums.agg(F.max("tokens_at_least")).first()[0] or 0
    return {"longer": longer, "tokens": tokens, "truncated_tokens": tokens - beyond + limit * longer}


def length_quantile(sums: DataFrame, share: float) -> int | None:
    """The smallest length that so large a share of the documents does not exceed."""
    return sums.filter(F.col("share_at_most") >= share).agg(F.min("length")).first()[0]
