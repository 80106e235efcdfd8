"""Nearest neighbours by inner product, with randomly rotated one-bit codes.

A vector is rotated by a random orthogonal matrix and kept as the signs of its components, packed in
64-bit words, with two scalars: its norm and the inner product of its direction with the direction of
its signs. From the packed bits of a candidate and a query in four-bit steps (four planes of bits) the
inner product is estimated, with an error bound that holds with high probability. A candidate is
reranked on the original vectors only if its upper bound reaches the k-th best lower bound.

Queries and candidates meet in blocks. Equal vectors are one candidate that stands for the k + 1
smallest ids that have it, which are all that can be among the k nearest of any query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.llm.tasks import Rows, groups
from shelfwise.session import materialize

K = 20
QUERY_EVERY = 20
#: Vectors of a block on either side.
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 8192
#: Standard errors of the estimate that the bounds allow for.
ERRORS = 3.0
_BITS = 4


def rotation(dimensions: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix."""
    drawn = np.random.Generator(np.random.PCG64(seed)).standard_normal((dimensions, dimensions))
    q, r = np.linalg.qr(drawn)
    return q * np.sign(np.diag(r))


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    width = -(-bits.shape[1] // 64) * 64
    full = np.zeros((len(bits), width), np.uint8)
    full[:, : bits.shape[1]] = bits
    return np.packbits(full, axis=1, bitorder="little").view(np.uint64)


class Codes:
    """One-bit codes of the rows of a matrix, with norm and correction scalars."""

    def __init__(self, vectors: np.ndarray, turn: np.ndarray):
        self.norms = np.linalg.norm(vectors, axis=1)
        unit = vectors @ turn.T / self.norms[:, None]
        self.d = unit.shape[1]
        positive = unit > 0
        self.bits = _packed(positive)
        self.ones = positive.sum(1)
        # <direction, direction of its signs>: what the estimate is divided by
        self.along = np.abs(unit).sum(1) / np.sqrt(self.d)
        self.spread = np.sqrt(np.maximum(0, 1 - self.along**2) / self.along**2 / max(1, self.d - 1))

    def estimate(self, queries: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(estimates, bounds on their errors) of the inner products, a row for each query."""
        turned = queries @ turn.T
        low = turned.min(1, keepdims=True)
        step = np.maximum((turned.max(1, keepdims=True) - low) / (2**_BITS - 1), 1e-300)
        steps = np.rint((turned - low) / step).astype(np.uint8)
        overlap = np.zeros((len(queries), len(self.bits)), np.int64)
        for b in range(_BITS):
            plane = _packed(steps >> b & 1)
            for w in range(plane.shape[1]):
                overlap += np.bitwise_count(plane[:, w, None] & self.bits[None, :, w]).astype(np.int64) << b
        # <signs, query> = 2 * sum over set bits - sum over all, of low + step * steps
        signed = 2 * (low * self.ones[None, :] + step * overlap) - (low * self.d + step * steps.sum(1, keepdims=True, dtype=np.int64))
        scale = self.norms / (self.along * np.sqrt(self.d))
        size = np.linalg.norm(queries, axis=1)[:, None]
        error = ERRORS * size * (self.norms * self.spread)[None, :] + 0.5 * step * np.sqrt(self.d) * scale[None, :] * ERRORS
        return signed * scale[None, :], error


def _usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and vector of the rows that take part: ids, and vectors that are finite, complete and not zero."""
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).filter("vec_id is not null and vector is not null")
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.filter(F.coalesce(fine, F.lit(False)) & F.exists("vector", lambda x: x != 0))


def nearest(
    embeddings: DataFrame,
    k: int = K,
    query_every: int = QUERY_EVERY,
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other vectors of each row of ``embeddings`` (vec_id, embedding).

    Queries are the rows whose vec_id is divisible by ``query_every``; a score is the inner product in
    double precision, ties go to the smaller vec_id, and a repeated row counts once. Rows with a null
    id, or with a vector that is null, empty, zero, or has null or non-finite components, take no
    part; vectors of different lengths are not compared. Fewer candidates give fewer rows.
    """
    rows = materialize(_usable(embeddings).distinct(), "vectors")
    ordered = Window.partitionBy("vector").orderBy("vec_id")
    same = (
        rows.withColumn("n", F.row_number().over(ordered))
        .filter(F.col("n") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    same = materialize(same.withColumn("place", F.xxhash64("vector")), "candidates")
    asked = rows.filter(F.col("vec_id") % query_every == 0)
    n_same, n_asked = same.count(), asked.count()
    blocks, query_blocks = max(1, -(-n_same // candidate_block)), max(1, -(-n_asked // query_block))
    one = same.select(
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q"), F.pmod("place", F.lit(blocks)).cast("int").alias("c"),
        F.size("vector").alias("d"), F.lit(0).alias("kind"), "ids", "vector",
    )
    other = asked.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int").alias("q"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("c"),
        F.size("vector").alias("d"), F.lit(1).alias("kind"), F.array("vec_id").alias("ids"), "vector",
    )
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        turns: dict[int, np.ndarray] = {}
        for group in groups(batches, 3):
            kind = group.column(3).to_numpy()
            d = group.column(2)[0].as_py()
            vectors = group.column(5).flatten().to_numpy().reshape(-1, d)
            ids = group.column(4)
            is_query = kind == 1
            if is_query.all() or not is_query.any():
                continue
            if d not in turns:
                turns[d] = rotation(d)
            listed = [ids[i].values.to_numpy() for i in np.flatnonzero(~is_query)]
            names = [ids[i].values[0].as_py() for i in np.flatnonzero(is_query)]
            for found in _search(vectors[~is_query], listed, vectors[is_query], names, turns[d], k):
                out.add(*found)
            yield from out.take()
        yield from out.take(1)

    met = one.union(other).repartition("q", "c", "d").sortWithinPartitions("q", "c", "d", "kind")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        met.mapInArrow(task, "query_id long, vec_id long, score double")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _search(vectors: np.ndarray, ids: list[np.ndarray], queries: np.ndarray, names: list[int], turn: np.ndarray, k: int, rows: int = 64):
    """(query_id, vec_id, score) columns of the k best candidates of each query in a block."""
    codes = Codes(vectors, turn)
    copies = np.array([len(i) for i in ids])
    for start in range(0, len(queries), rows):
        part = queries[start : start + rows]
        guess, error = codes.estimate(part, turn)
        lower, upper = guess - error, guess + error
        # the query itself may be one of the candidates, so one more is kept
        many = min(k + 1, len(vectors))
        reach = -np.partition(-lower, many - 1, axis=1)[:, many - 1]
        for row, name in enumerate(names[start : start + rows]):
            near = np.flatnonzero(upper[row] >= reach[row])
            exact = (vectors[near] * part[row]).sum(1)
            if len(near) > many:
                cut = np.partition(exact, len(exact) - many)[len(exact) - many]
                keep = exact >= cut
                near, exact = near[keep], exact[keep]
            all_ids = np.concatenate([ids[i] for i in near])
            scores = np.repeat(exact, copies[near])
            other = all_ids != name
            all_ids, scores = all_ids[other], scores[other]
            order = np.lexsort((all_ids, -scores))[:k]
            if len(order):
                yield np.full(len(order), name), all_ids[order], scores[order]
