"""Document fingerprints from prefix polynomial hashes.

Of a text's code points the prefix arrays keep a polynomial modulo two primes. They give a hash of
any span in constant time, so two spans are compared without reading them, and the longest common
extension of two places is found by binary search. A fingerprint holds the length, the hash of the
whole text and the ``SKETCH`` smallest hashes of its spans of ``SPAN`` code points; the likeness of two
fingerprints estimates the share of spans that two texts have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.texts import mix

_PRIMES = (2147483629, 2147483587)
_BASES = (1103515245 % 2147483629, 747796405)
SPAN = 8
SKETCH = 32
#: Code points that are hashed together.
CHUNK = 1_000_000
_LOWEST = -(2**63)
_powers: dict[int, np.ndarray] = {}


def _modular_powers(which: int, n: int) -> np.ndarray:
    known = _powers.get(which)
    if known is None or len(known) < n:
        p = np.uint64(_PRIMES[which])
        known = np.ones(max(n, 1 << 16), np.uint64)
        done, step = 1, _BASES[which]
        while done < len(known):  # the powers so far times base**done
            m = min(done, len(known) - done)
            known[done : done + m] = known[:m] * np.uint64(step) % p
            step, done = step * step % _PRIMES[which], done + m
        if len(known) <= 4 * CHUNK:
            _powers[which] = known
    return known[:n]


class PrefixHashes:
    """Modular prefix arrays of a sequence of code points."""

    def __init__(self, points: np.ndarray):
        self.n = len(points)
        self.powers = [_modular_powers(k, self.n + 1) for k in range(2)]
        self.sums = []
        for k, p in enumerate(_PRIMES):
            h = np.zeros(self.n + 1, np.uint64)
            np.cumsum((points.astype(np.uint64) + np.uint64(1)) * self.powers[k][: self.n] % np.uint64(p), out=h[1:])
            self.sums.append(h % np.uint64(p))

    def spans(self, starts: np.ndarray, ends: np.ndarray, total: int | None = None) -> np.ndarray:
        """Hashes of the spans; comparable between sequences hashed with the same ``total`` (by default ``n``)."""
        made = []
        for k, p in enumerate(_PRIMES):
            p = np.uint64(p)
            shift = self.powers[k] if total is None else _modular_powers(k, total + 1)
            top = self.n if total is None else total
            made.append((self.sums[k][ends] + p - self.sums[k][starts]) % p * shift[top - starts] % p)
        return made[0] << np.uint64(31) | made[1]


def common_extension(a: PrefixHashes, i: np.ndarray, b: PrefixHashes, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """How many code points from place i of a and place j of b on are equal, ``limit`` at most."""
    total = max(a.n, b.n)
    low, high = np.zeros(len(limit), np.int64), limit.astype(np.int64).copy()
    while (low < high).any():
        middle = (low + high + 1) // 2
        equal = a.spans(i, i + middle, total) == b.spans(j, j + middle, total)
        low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
    return low


def sketches(texts: list[str]) -> tuple[PrefixHashes, np.ndarray, list[str]]:
    """(hashes of the joined texts, offsets, fingerprint of each text)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    hashed = PrefixHashes(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32))
    whole = _aligned(hashed, offsets[:-1], offsets[1:])
    at = np.arange(max(0, hashed.n - SPAN + 1))
    spans = mix(_aligned(hashed, at, at + SPAN)) >> np.uint64(16)
    made = []
    for k, n in enumerate(sizes.tolist()):
        if n >= SPAN:
            mine = spans[offsets[k] : offsets[k] + n - SPAN + 1]
            if len(mine) > 4 * SKETCH:
                # repeated spans are equal hashes, so look at ever more of the smallest until there are enough
                m = 2 * SKETCH
                while True:
                    least = np.unique(np.partition(mine, m - 1)[:m]) if m < len(mine) else np.unique(mine)
                    if len(least) > SKETCH or m >= len(mine):
                        break
                    m *= 4
            else:
                least = np.unique(mine)
            least = least[:SKETCH]
        else:
            least = mix(whole[k : k + 1] + np.uint64(n)) >> np.uint64(16) if n else spans[:0]
        made.append(f"{n:x}.{int(whole[k]):016x}." + "".join(f"{v:012x}" for v in least.tolist()))
    return hashed, offsets, made


_INVERSES = tuple(pow(b, -1, p) for b, p in zip(_BASES, _PRIMES))
_inverse_powers: dict[int, np.ndarray] = {}


def _aligned(hashed: PrefixHashes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Span hashes as if each span stood at the start of a sequence."""
    made = []
    for k, p in enumerate(_PRIMES):
        known = _inverse_powers.get(k)
        if known is None or len(known) < hashed.n + 1:
            known = np.ones(max(hashed.n + 1, CHUNK), np.uint64)
            done, step = 1, _INVERSES[k]
            while done < len(known):
                m = min(done, len(known) - done)
                known[done : done + m] = known[:m] * np.uint64(step) % np.uint64(p)
                step, done = step * step % p, done + m
            if len(known) <= 4 * CHUNK:
                _inverse_powers[k] = known
        p = np.uint64(p)
        made.append((hashed.sums[k][ends] + p - hashed.sums[k][starts]) % p * known[starts] % p)
    return made[0] << np.uint64(31) | made[1]


def likeness(one: str, other: str) -> float:
    """Of the smallest span hashes of both fingerprints together the share that both have; 1 if they are equal."""
    if one == other:
        return 1.0
    a, b = (x.rsplit(".", 1)[1] for x in (one, other))
    a, b = ({x[i : i + 12] for i in range(0, len(x), 12)} for x in (a, b))
    least = sorted(a | b)[:SKETCH]
    return sum(x in a and x in b for x in least) / len(least) if least else 0.0


def in_turn(documents: DataFrame, parts: int | None = None) -> DataFrame:
    """bucket, ahead, doc_id, text: the rows by descending doc_id, dealt to partitions by ranges of ids.

    Within a partition the rows are sorted by bucket and order; after those of its own, a bucket has
    the first row of the next bucket too (ahead = 1; the last bucket that of the first). Rows
    without an id come last, rows of one id by descending text. Only ids of the ``parts`` range
    bounds and first rows come to the driver.
    """
    spark = documents.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("k", F.coalesce("doc_id", F.lit(_LOWEST)))
    cuts = rows.agg(F.percentile_approx("k", [i / parts for i in range(1, parts)] or [0.5], 10_000)).first()[0]
    bounds = np.unique(np.array(cuts or [], np.int64)) if parts > 1 else np.zeros(0, np.int64)

    @F.pandas_udf("int")
    def bucket(key: pd.Series) -> pd.Series:
        return pd.Series(len(bounds) - np.searchsorted(bounds, key.to_numpy()), dtype="int32")

    rows = rows.withColumn("bucket", bucket("k"))
    heads = sorted((r[0], r[1]) for r in rows.groupBy("bucket").agg(F.max("k")).collect())
    before = [(k, heads[i - 1][0]) for i, (_, k) in enumerate(heads)]
    first = spark.createDataFrame(before, "k long, previous int")
    own = F.struct(F.col("bucket"), F.lit(0).alias("ahead"))
    also = F.struct(F.col("previous").alias("bucket"), F.lit(1).alias("ahead"))
    placed = rows.join(F.broadcast(first), "k", "left").select(
        F.explode(F.when(F.col("previous").isNull(), F.array(own)).otherwise(F.array(own, also))).alias("p"), "k", "doc_id", "text"
    )
    placed = placed.select("p.bucket", "p.ahead", "k", "doc_id", "text")
    return placed.repartition(parts, "bucket").sortWithinPartitions("bucket", "ahead", F.desc("k"), F.desc("text")).select("bucket", "ahead", "doc_id", "text")


def edited_fingerprints(documents: DataFrame, parts: int | None = None) -> DataFrame:
    """A row for each row of ``documents`` (doc_id, text; others unused).

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next and
    common_prefix (code points that the text and its edited form share from the start, by binary
    search). The edited form replaces the last third by the start of the next text in turn. A null
    text is empty; a single row is its own next.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "common_prefix"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]

    def block(rows: list[tuple]) -> pa.RecordBatch:
        """Rows and their followers; the last row is only a follower."""
        texts = [r[3] for r in rows]
        hashed, offsets, prints = sketches(texts)
        mine = [i for i, r in enumerate(rows[:-1]) if not r[1] and rows[i + 1][0] == r[0]]
        edited = []
        for i in mine:
            m = len(texts[i]) // 3
            edited.append(texts[i][: len(texts[i]) - m] + texts[i + 1][:m])
        again, places, new = sketches(edited)
        sizes = np.array([len(texts[i]) for i in mine], np.int64)
        shared = common_extension(hashed, offsets[mine], again, places[:-1], np.minimum(sizes, np.diff(places))) if mine else []
        columns = [
            [rows[i][2] for i in mine],
            sizes,
            [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
            [prints[i] for i in mine],
            new,
            [likeness(prints[i], e) for i, e in zip(mine, new)],
            [likeness(prints[i], prints[i + 1]) for i in mine],
            shared,
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            fixed = [batch.column(k).to_pylist() for k in range(3)]
            for k, row in enumerate(zip(*fixed)):
                text = batch.column(3)[k].as_py()
                held.append((*row, text))
                size += len(text)
                if size >= CHUNK and len(held) > 1:
                    yield block(held)
                    held, size = held[-1:], len(text)
        if len(held) > 1:
            yield block(held)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_prefix long"
    return in_turn(documents, parts).mapInArrow(task, schema)
