"""MinHash near-duplicates: an inverted join on signature coordinates, confirmed on full shingle sets.

1. Each text becomes its set of word shingles and a signature of ``COORDINATES`` minima. Documents
   with the same set are one class, and only one member of a class goes on.
2. A class is posted under each (coordinate, value) of its signature. Two classes whose sets have
   the wanted similarity agree in at least ``matches_needed`` coordinates, but for a chance below
   ``MISS``. They then share a value within the ``prefix`` of rarest values of both, so only those
   are posted to the join; values that many unrelated documents share (of a common passage, say)
   lie outside the prefixes.
3. Within a posting list collisions are counted coordinate by coordinate, and a pair is skipped as
   soon as what is left can't lift it over the threshold. Long lists are split into blocks that
   meet pairwise. A task returns as many pairs as connect what its matches connect, so a group of
   copies never becomes all of its pairs.
4. In each group of classes so connected, all pairs of similar size are held against each other on
   their full sets, again in blocks. The links found form the components.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.components import connected_components
from shelfwise.llm.idsets import mark_possible
from shelfwise.llm.tasks import Rows, forest, groups
from shelfwise.llm.texts import shingles, text_chunks
from shelfwise.session import materialize

COORDINATES = 48
SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 85
#: Bound on the chance that a pair of just the wanted similarity matches in too few coordinates.
MISS = 1e-6
#: Members of a block of a posting list.
LIST_BLOCK = 1024
#: Shingles of all members of a block in the exact comparison.
SET_BLOCK = 1 << 19
#: Members of a block in the exact comparison, however short: a task holds matrices of twice as many rows and columns.
MEMBER_BLOCK = 1024

_SIGNATURES = "doc_id long, n_shingles long, set_key binary, signature array<int>"


def matches_needed(coordinates: int, percent: int, miss: float = MISS) -> int:
    """The largest t such that fewer than t of the coordinates agree with a chance below ``miss``."""
    p, below, t = percent / 100, 0.0, 0
    while True:
        below += math.comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if below > miss:
            return max(1, t)
        t += 1


def _multipliers(coordinates: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(77)).integers(0, 2**64, coordinates, dtype=np.uint64) | np.uint64(1)


def minhash(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of minima for each set that isn't empty."""
    values = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    made = np.empty((len(sets), coordinates), np.uint32)
    for k, factor in enumerate(_multipliers(coordinates)):
        made[:, k] = np.minimum.reduceat((values * factor) >> np.uint64(32), starts)
    return made


def _set_key(elements: np.ndarray) -> bytes | None:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest() if len(elements) else None


def signatures(documents: DataFrame, coordinates: int = COORDINATES, width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, n_shingles, set_key (digest of the set) and signature; the last two null without words."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(1)):
                sets = shingles(data, offsets, width)
                full = [s for s in sets if len(s)]
                rows = iter(minhash(full, coordinates).view(np.int32) if full else ())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i).cast(pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_set_key(s) for s in sets], pa.binary()),
                        pa.array([next(rows) if len(s) else None for s in sets], pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "n_shingles", "set_key", "signature"],
                )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, _SIGNATURES)


def _candidate_links(classes: DataFrame, coordinates: int, needed: int, block: int) -> DataFrame:
    """Pairs (a, b) of classes that connect all classes with enough matching coordinates."""
    prefix = coordinates - needed + 1
    postings = classes.select("c", F.posexplode("signature")).select(
        (F.shiftleft(F.col("pos").cast("long"), 32) + F.col("col").cast("long").bitwiseAND(0xFFFFFFFF)).alias("item"), "c"
    )
    shared = postings.groupBy("item").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Spark takes an exploded table for as large as the one before, and an array for one element: it would broadcast
    # the postings. So these joins are merge joins, whatever the sizes look like.
    rarest = (
        postings.join(shared.hint("merge"), "item")
        .groupBy("c")
        .agg(F.sort_array(F.collect_list(F.struct("n", "item"))).alias("items"))
        # values of one class alone come first in the prefix, and lead nowhere
        .withColumn("items", F.slice("items", 1, F.greatest(F.lit(0), F.lit(prefix - coordinates) + F.size("items"))))
        .filter("size(items) > 0")
    )
    posted = (
        rarest.join(classes.select("c", "signature").hint("merge"), "c")
        .select("c", "signature", F.explode("items").alias("i"))
        .select("c", "signature", F.col("i.item").alias("item"), F.ceil(F.col("i.n") / block).cast("long").alias("blocks"))
        .withColumn("own", F.pmod(F.xxhash64("c"), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("item", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "c", "signature")
    )

    def task(batches):
        out = Rows(pa.schema([("a", pa.int64()), ("b", pa.int64())]))
        for group in groups(batches, 3):
            if group.num_rows > 1:
                ids = group.column(4).to_numpy()
                sign = group.column(5).flatten().to_numpy().reshape(len(ids), -1)
                pairs = forest(len(ids), *_matching(sign, needed))
                if pairs:
                    out.add(*(ids[list(side)] for side in zip(*pairs)))
                yield from out.take()
        yield from out.take(1)

    keys = ["item", "lo", "hi"]
    return posted.repartition(*map(F.col, keys)).sortWithinPartitions(*keys, "c").mapInArrow(task, "a long, b long")


def _matching(signatures: np.ndarray, needed: int, rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that agree in at least ``needed`` coordinates."""
    n, coordinates = signatures.shape
    left, right = [], []
    columns = np.ascontiguousarray(signatures.T)
    # so many coordinates for all pairs at once, the others for the pairs that can still reach the threshold
    first = min(coordinates, coordinates - needed + 2)
    for i in range(0, n, rows):
        j = min(n, i + rows)
        counts = np.zeros((j - i, n - i), np.uint8 if coordinates < 256 else np.int32)
        for k in range(first):
            counts += columns[k, i:j, None] == columns[k, None, i:]
        x, y = np.nonzero(counts >= max(1, needed - (coordinates - first)))
        x, y = x[y > x], y[y > x]
        total = counts[x, y].astype(np.int64)
        for k in range(first, coordinates):
            total += columns[k, i + x] == columns[k, i + y]
            if k % 8 == 7:
                alive = total >= needed - (coordinates - 1 - k)
                x, y, total = x[alive], y[alive], total[alive]
        hit = total >= needed
        left.append(i + x[hit])
        right.append(i + y[hit])
    return np.concatenate(left), np.concatenate(right)


def similar_pairs(sets: list[np.ndarray], percent: int, columns: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with 100 * intersection >= percent * union, by counting shared elements exactly."""
    sizes = np.array([len(s) for s in sets], np.int64)
    values = np.concatenate(sets)
    owners = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    often = np.diff(np.r_[first, len(values)])
    place = np.repeat(np.where(often > 1, np.cumsum(often > 1) - 1, -1), often)
    owners, place = owners[place >= 0], place[place >= 0]
    common = np.zeros((len(sets), len(sets)), np.int64)
    distinct = int(place[-1]) + 1 if len(place) else 0
    for start in range(0, distinct, columns):
        i, j = np.searchsorted(place, [start, start + columns])
        marks = np.zeros((len(sets), min(columns, distinct - start)), np.float32)
        marks[owners[i:j], place[i:j] - start] = 1
        common += np.rint(marks @ marks.T).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    return np.nonzero(np.triu(100 * common >= percent * union, 1))


def _exact_links(documents: DataFrame, members: DataFrame, percent: int, width: int, block: int, most: int) -> DataFrame:
    """Pairs (a, b) that connect all members of a group whose full sets are similar enough.

    members: c (a doc_id) and set_key (one of its sets), n_shingles, g (the group). A block has about ``block`` shingles and
    ``most`` members at the most.
    """
    step = math.log(100 / percent)  # sets whose sizes lie further apart than this factor can't be similar
    cells = members.withColumn("s", F.floor(F.log("n_shingles") / step).cast("int"))
    blocks = (
        cells.groupBy("g", "s")
        .agg(F.sum("n_shingles").alias("n"), F.count(F.lit(1)).alias("members"))
        .withColumn("blocks", F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("members") / most)).cast("int"))
    )
    of_group = blocks.groupBy("g").agg(
        ((F.sum("n") <= block) & (F.sum("members") <= most)).alias("small"), F.map_from_entries(F.collect_list(F.struct("s", "blocks"))).alias("blocks")
    )

    def meeting(neighbour: int):
        """The blocks of the cell of the same or of a neighbouring size that a member's own block meets."""
        there = F.coalesce(F.try_element_at("blocks", F.col("s") + neighbour), F.lit(0))
        return F.transform(
            F.when(there > 0, F.sequence(F.lit(0), there - 1)).otherwise(F.array().cast("array<int>")),
            lambda k: F.struct(
                (F.col("s") + min(0, neighbour)).alias("s"),
                F.lit(abs(neighbour)).alias("up"),
                (F.least("own", k) if not neighbour else F.col("own") if neighbour > 0 else k).alias("x"),
                (F.greatest("own", k) if not neighbour else k if neighbour > 0 else F.col("own")).alias("y"),
            ),
        )

    whole = F.array(F.struct(F.lit(-1).alias("s"), F.lit(0).alias("up"), F.lit(0).alias("x"), F.lit(0).alias("y")))
    placed = (
        cells.join(of_group, "g")
        .withColumn("own", F.pmod(F.xxhash64("set_key"), F.coalesce(F.try_element_at("blocks", "s"), F.lit(1))).cast("int"))
        .select("c", "set_key", "g", F.when(F.col("small"), whole).otherwise(F.concat(meeting(0), meeting(1), meeting(-1))).alias("meets"))
    )

    def with_key(batches):
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(1)):
                keys = [_set_key(s) for s in shingles(data, offsets, width)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(keys, pa.binary()), batch.column(1).slice(i, j - i)], names=["c", "set_key", "text"])

    def to_sets(batches):
        schema = pa.schema([("g", pa.int64()), ("s", pa.int32()), ("up", pa.int32()), ("x", pa.int32()), ("y", pa.int32()), ("c", pa.int64()), ("elements", pa.binary())])
        for batch in batches:
            out = Rows(schema)
            for i, j, data, offsets in text_chunks(batch.column(3)):
                for at, elements in enumerate(shingles(data, offsets, width), i):
                    meets = batch.column(2)[at].as_py()
                    n = len(meets)
                    out.add([batch.column(1)[at].as_py()] * n, *([m[k] for m in meets] for k in ("s", "up", "x", "y")), [batch.column(0)[at].as_py()] * n, [elements.tobytes()] * n)
                    if out.count >= 500:
                        yield from out.take(1)
            yield from out.take(1)

    def compare(batches):
        out = Rows(pa.schema([("a", pa.int64()), ("b", pa.int64())]))
        for group in groups(batches, 5):
            if group.num_rows > 1:
                ids = group.column(5).to_numpy()
                sets = [np.frombuffer(e.as_buffer(), np.uint64) for e in group.column(6)]
                pairs = forest(len(ids), *similar_pairs(sets, percent))
                if pairs:
                    out.add(*(ids[list(side)] for side in zip(*pairs)))
                yield from out.take()
        yield from out.take(1)

    keys = ["g", "s", "up", "x", "y"]
    text = documents.select(F.col("doc_id").cast("long").alias("c"), "text")
    text = mark_possible(text, "c", members.select("c")).filter("possible").select("c", "text")
    # an id may have several texts, and a text several rows: one text for each set of an id
    text = text.mapInArrow(with_key, "c long, set_key binary, text string").groupBy("c", "set_key").agg(F.min("text").alias("text"))
    return (
        placed.join(text.hint("merge"), ["c", "set_key"])  # the blocks that a member meets, and texts, are larger than Spark takes them for
        .select("c", "g", "meets", "text")
        .mapInArrow(to_sets, "g long, s int, up int, x int, y int, c long, elements binary")
        .repartition(*map(F.col, keys))
        .sortWithinPartitions(*keys)
        .mapInArrow(compare, "a long, b long")
    )


def near_duplicates(
    documents: DataFrame,
    percent: int = SIMILARITY_PERCENT,
    coordinates: int = COORDINATES,
    width: int = SHINGLE_WORDS,
    list_block: int = LIST_BLOCK,
    set_block: int = SET_BLOCK,
    member_block: int = MEMBER_BLOCK,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``documents`` (doc_id, text; others unused).

    Documents are linked if 100 * |intersection| >= percent * |union| of their shingle sets.
    component_id is the smallest doc_id that links lead to, kept whether that is the row itself.
    Rows that share a doc_id are one document. A null text is empty; texts without words, and rows
    without a doc_id, are linked with nothing and kept.
    """
    signed = materialize(signatures(documents, coordinates, width), "signatures")
    classes = materialize(
        signed.filter("set_key is not null and doc_id is not null")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("c"), F.min_by("signature", "doc_id").alias("signature"), F.min("n_shingles").alias("n_shingles")),
        "classes",
    )
    # rows that share a doc_id connect their classes
    same_row = signed.filter("set_key is not null").select("doc_id", "set_key").join(classes.select("set_key", "c"), "set_key")
    needed = matches_needed(coordinates, percent)
    groups_ = connected_components(_candidate_links(classes, coordinates, needed, list_block))
    members = classes.select("c", "set_key", "n_shingles").join(
        groups_.select(F.col("node").alias("c"), F.col("component").alias("g")), "c"
    )
    links = _exact_links(documents, materialize(members, "members"), percent, width, set_block, member_block)
    several = same_row.groupBy("doc_id").agg(F.min("c").alias("a"), F.max("c").alias("b")).filter("a < b").select("doc_id")
    ties = same_row.join(several, "doc_id", "left_semi").select("doc_id", "c").filter("c <> doc_id").distinct()
    joined = connected_components(links.union(ties))
    named = classes.select("set_key", "c").join(joined.withColumnRenamed("node", "c"), "c", "left")
    # by doc_id: a text without words has the component of its id's other texts
    of_id = same_row.select("doc_id", "set_key").join(named.select("set_key", F.coalesce("component", "c").alias("of")), "set_key")
    of_id = of_id.groupBy("doc_id").agg(F.min("of").alias("of"))
    component = F.coalesce("of", "doc_id")
    return signed.select("doc_id", "n_shingles").join(of_id, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
