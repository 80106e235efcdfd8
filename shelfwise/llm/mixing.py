"""Temperature mixing: sources weighted by their token shares to a power, realised in whole documents.

A source with token share p gets a weight in proportion to p**a: a = 1 leaves the corpus as it is,
a = 0 makes all sources equal. The exponent is bisected (16 sections at a time, each a sum over the
sources) so that the weights have a wanted entropy, or as even as a limit on repetition allows.
Weights times the token budget are the quotas. A quota of more than a source's tokens takes all its
documents several times; the rest takes its blocks in an order drawn for the source, the last block
document by document. Blocks are hashed, so a source with a third of all rows is spread over them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.session import materialize

BLOCKS = 1024
SECTIONS = 16
ROUNDS = 6


@dataclass(frozen=True)
class Mixture:
    """exponent and budget of a mixture, and its parts: source, tokens, weight, quota."""

    exponent: float
    budget: float
    parts: DataFrame


def word_count(text: Column) -> Column:
    """Words between white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^ \\t-\\r]+")).cast("long")


def _at_exponents(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """For each exponent: entropy, largest weight per token, smallest weight per token."""
    p, columns = F.col("p"), []
    for a in exponents:
        power = F.pow(p, F.lit(a))
        columns += [F.sum(power), F.sum(power * F.log(p)), F.max(F.pow(p, F.lit(a - 1))), F.min(F.pow(p, F.lit(a - 1)))]
    row = sources.agg(*columns).first()
    found = []
    for k, a in enumerate(exponents):
        z, plogp, most, least = row[4 * k : 4 * k + 4]
        found.append((math.log(z) - a * plogp / z, most / z, least / z))
    return found


def mixture(
    totals: DataFrame,
    entropy_share: float | None = None,
    max_repeats: float | None = None,
    budget: float | None = None,
    cover: bool = False,
) -> Mixture:
    """Weights of the sources in ``totals`` (source, tokens).

    entropy_share: wanted entropy as a share of the largest possible one. max_repeats: how often
    the documents of a source may be used; it goes before the entropy. budget: tokens of the mixture,
    by default those of the corpus; ``cover`` makes it as large as it takes to use every document
    at least once. Sources without tokens have no part.
    """
    totals = totals.filter("tokens > 0")
    row = totals.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    total, n = float(row[0] or 0), row[1]
    sources = totals.withColumn("p", F.col("tokens") / total) if total else totals.withColumn("p", F.lit(0.0))

    def fits(entropy, most, least) -> bool:
        """Whether an exponent is at least as even as wanted (entropy) or stays within the limit (repeats)."""
        repeats = most / least if cover else most * (budget or total) / total
        return repeats <= max_repeats + 1e-9

    exponent = 1.0
    if n > 1 and entropy_share is not None:
        exponent = _bisect(sources, lambda e, *_: e >= entropy_share * math.log(n), low=True)
    if n > 1 and max_repeats is not None:
        exponent = max(exponent if entropy_share is not None else 0.0, _bisect(sources, fits, low=False))
    powers = sources.withColumn("power", F.pow("p", F.lit(exponent)))
    z, most_per_token = (powers.agg(F.sum("power"), F.max(F.col("tokens") / F.col("power"))).first() if total else (1.0, 0.0))
    if cover:
        budget = z * most_per_token
    budget = float(total if budget is None else budget)
    parts = powers.select("source", "tokens", (F.col("power") / z).alias("weight"), (F.col("power") / z * budget).alias("quota"))
    return Mixture(exponent, budget, parts)


def _bisect(sources: DataFrame, holds, low: bool) -> float:
    """The end of the exponents of 0 to 1 for which ``holds``: they are below it (low) or above it."""
    a, b = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [a + (b - a) * k / SECTIONS for k in range(SECTIONS + 1)]
        yes = [holds(*x) for x in _at_exponents(sources, grid)]
        if low:
            k = max([i for i, y in enumerate(yes) if y], default=0)
            a, b = grid[k], grid[min(k + 1, SECTIONS)]
        else:
            k = min([i for i, y in enumerate(yes) if y], default=SECTIONS)
            a, b = grid[max(k - 1, 0)], grid[k]
        if a == b:
            break
    return a if low else b


def mix_sources(
    documents: DataFrame,
    tokens: Column | None = None,
    entropy_share: float | None = None,
    max_repeats: float | None = None,
    budget: float | None = None,
    cover: bool = False,
    seed: int = 0,
    blocks: int = BLOCKS,
    text_key: bool = False,
) -> DataFrame:
    """doc_id, source, tokens, copies: how often the mixture uses each row of ``documents`` (doc_id, source, text).

    tokens: tokens of a row, by default its words. A null source is a source of its own, named by
    the empty text like the empty one. Rows without tokens cost nothing and are used as often as
    their source is used in full, once at least. A source takes no more than its quota, and less by
    less than one document. ``text_key`` adds a column of that name, a hash of the text, by which the
    rows of one doc_id can be told apart.
    """
    # rows that share an id and a size are drawn by their text; only rows equal in all of them draw alike
    draw = F.xxhash64(F.lit(seed), "doc_id", "tokens", "text_hash")
    key = ["text_key"] if text_key else []
    rows = documents.select(
        "doc_id",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(tokens if tokens is not None else word_count(F.col("text")), F.lit(0)).cast("long").alias("tokens"),
        F.xxhash64("text").alias("text_hash"),
    ).withColumn("draw", draw)
    rows = materialize(rows.withColumn("block", F.pmod("draw", F.lit(blocks)).cast("int")), "tokens")
    sums = materialize(rows.groupBy("source", "block").agg(F.sum("tokens").alias("block_tokens")), "blocks")
    made = mixture(sums.groupBy("source").agg(F.sum("block_tokens").alias("tokens")), entropy_share, max_repeats, budget, cover)
    parts = made.parts.select(
        "source",
        F.floor(F.col("quota") / F.col("tokens") + 1e-9).cast("int").alias("full"),
        F.col("quota").alias("quota"),
        F.col("tokens").alias("of_source"),
    ).withColumn("rest", F.col("quota") - F.col("full") * F.col("of_source") + F.lit(1e-6))
    shuffled = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "block", "source"), "block")
    before = F.sum("block_tokens").over(shuffled) - F.col("block_tokens")
    decided = sums.join(parts, "source", "left").select(
        "source", "block", F.coalesce("full", F.lit(1)).alias("full"), (F.coalesce("rest", F.lit(0.0)) - before).alias("left")
    )
    running = F.sum("tokens").over(Window.partitionBy("source", "block").orderBy("draw", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, 0))
    return (
        rows.withColumn("running", running)
        .join(decided, ["source", "block"])
        .select(
            "doc_id",
            "source",
            "tokens",
            F.when(F.col("tokens") == 0, F.greatest("full", F.lit(1)))
            .otherwise(F.col("full") + (F.col("running") <= F.col("left")).cast("int"))
            .alias("copies"),
            *(F.col("text_hash").alias(k) for k in key),
        )
    )
