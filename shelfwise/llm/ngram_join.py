"""N-gram Jaccard join by vertical partitioning.

All n-grams have one global order: rare ones first, as a table of counts by hash slot tells, then by
hash. The order is cut into fragments, and a text's set into its segments in them.

1. Texts with the same set are one class. Two classes whose sets overlap enough share an n-gram among
   the first of both in the global order (the prefix), so classes are posted under those alone.
2. For a pair of classes, each fragment counts what the two segments have in common, and the partial
   counts are summed: exactly the overlap.
3. Pairs come in rounds, since only components are asked for. First every class with one class that many
   of its lists have in common. Then, in the lists that still hold several components, pairs of different
   ones, as many as connect all that may be linked, the most alike first; last, if one of those was no link,
   all that are left.
   A pair is left out only where it can't be a link: by size, or because the sizes of the sets in
   ranges of hashes, taken range by range, don't allow the overlap.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.llm.components import connected_components
from shelfwise.llm.idsets import mark_possible
from shelfwise.llm.tasks import Rows, forest, groups
from shelfwise.llm.texts import shingles, text_chunks
from shelfwise.session import materialize

NGRAM_WORDS = 4
SIMILARITY_PERCENT = 85
#: Fragments of the global order.
FRAGMENTS = 8
#: Slots of the table of counts, as a power of two: it is broadcast, a byte for each slot, whatever the corpus.
#: In a corpus with many n-grams to a slot, only those that are much more frequent still stand out; the order stays
#: one order, and lists are longer.
SLOT_BITS = 23
_PART_BITS = 17
#: Ranges of hashes whose sizes bound an overlap from above, as a power of two. A size is a byte, at most ``FULL``.
CELL_BITS = 8
FULL = 255
#: Members of a block of a list, or of one class's partners.
BLOCK = 1024
#: Shingles of a block of one class's partners.
BLOCK_SHINGLES = 1 << 21
#: Lists of a class, by token, that its rows carry, so that a pair is found in the first list that both are in.
FIRST_LISTS = 64
#: Bytes of text that are taken apart at once.
CHUNK = 400_000


def _frequency_table(documents: DataFrame, width: int, bits: int) -> np.ndarray:
    """For each slot of hashes the bit length of the number of its n-grams in all texts.

    A task counts its texts in one table of fixed size and returns it in parts, which are summed by part.
    """
    part = min(_PART_BITS, bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(1 << bits, np.uint32), False
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0), CHUNK):
                found = [s for s in shingles(data, offsets, width) if len(s)]
                if found:
                    np.add.at(counts, (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64), 1)
                    seen = True
        if seen:
            counts = np.minimum(counts, 255).astype(np.uint8).reshape(-1, 1 << part)
            for i, row in enumerate(counts):
                if row.any():
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([row.tobytes()], pa.binary())], names=["part", "counts"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[i] = sums.get(i, 0) + np.frombuffer(counts.as_buffer(), np.uint8).astype(np.int64)
        for i, summed in sums.items():
            lengths = np.frexp(summed.astype(np.float64))[1].astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([lengths.tobytes()], pa.binary())], names=["part", "counts"])

    parts = documents.select("text").mapInArrow(count, "part int, counts binary").repartition(F.col("part")).mapInArrow(total, "part int, counts binary")
    table = np.zeros((1 << (bits - part), 1 << part), np.uint8)
    for row in parts.collect():  # 2**bits bytes in all
        table[row.part] = np.frombuffer(row.counts, np.uint8)
    return table.reshape(-1)


class Order:
    """The global order of n-grams and its fragments."""

    def __init__(self, table: np.ndarray, fragments: int):
        self.table, self.bits = table, int(len(table)).bit_length() - 1
        self.shift = np.uint64(64 - self.bits)
        # fragments hold about as many n-grams: slots in order, weighted by what they count
        ranked = np.argsort(table, kind="stable")
        weight = np.cumsum(np.exp2(table[ranked].astype(np.float64)) * (table[ranked] > 0))
        heads = ranked[np.searchsorted(weight, weight[-1] * np.arange(1, fragments) / fragments)]
        self.pivots = (table[heads].astype(np.int64) << self.bits) | heads

    def ranks(self, elements: np.ndarray) -> np.ndarray:
        """The first part of the order; elements are sorted by hash, the second part."""
        return self.table[(elements >> self.shift).astype(np.int64)]

    def prefix(self, elements: np.ndarray, length: int) -> np.ndarray:
        return elements[np.argsort(self.ranks(elements), kind="stable")[:length]]

    def fragments(self, elements: np.ndarray) -> np.ndarray:
        slots = (elements >> self.shift).astype(np.int64)
        return np.searchsorted(self.pivots, (self.table[slots].astype(np.int64) << self.bits) | slots, "right").astype(np.uint8)

    def segments(self, elements: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(fragment, its n-grams by hash) of those that aren't empty."""
        of = self.fragments(elements)
        order = np.argsort(of, kind="stable")
        cuts = np.flatnonzero(np.diff(of[order])) + 1
        for at in np.split(order, cuts):
            if len(at):
                yield int(of[at[0]]), elements[at]


def _class_key(elements: np.ndarray) -> int | None:
    if not len(elements):
        return None
    return int.from_bytes(hashlib.blake2b(elements.tobytes(), digest_size=8).digest(), "little", signed=True)


def _cells(elements: np.ndarray) -> bytes:
    return np.minimum(np.bincount((elements >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=1 << CELL_BITS), FULL).astype(np.uint8).tobytes()


def _allows(x: np.ndarray, y: np.ndarray, n_x: np.ndarray, n_y: np.ndarray, percent: int) -> np.ndarray:
    """Whether the overlap of two sets, row by row, can be large enough: range by range it is at most the smaller size.

    Where both sizes are full, they are not known, and the overlap may be anything.
    """
    least = np.minimum(x, y)
    most = least.sum(axis=1, dtype=np.int64)
    return ((100 + percent) * most >= percent * (n_x + n_y)) | (least.max(axis=1, initial=0) == FULL)


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _prefixes(documents: DataFrame, order, width: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, k (64-bit digest of the set), prefix, cells; the last three null without words."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = order.value
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(1), CHUNK):
                sets = shingles(data, offsets, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_class_key(s) for s in sets], pa.int64()),
                        pa.array([known.prefix(s, prefix_length(len(s), percent)).view(np.int64) if len(s) else None for s in sets], pa.list_(pa.int64())),
                        pa.array([_cells(s) if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "k", "prefix", "cells"],
                )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, "doc_id long, n_shingles long, k long, prefix array<long>, cells binary")


def _lists(classes: DataFrame, percent: int) -> DataFrame:
    """(token, k, s, copies): classes posted under the n-grams of their prefixes, where several of similar size are.

    s is the logarithm of the size. Few postings share their n-gram with one of a similar size: all are dealt by token
    once, and only those go on. Texts that share a passage share many n-grams, whose lists are the same: of those with
    the same members, as 128 bits of them tell, one is kept, with their number.
    """
    step = math.log(100 / percent)  # sets whose s differ by more than one can't be similar
    postings = classes.select("k", F.floor(F.log("n") / step).cast("int").alias("s"), F.explode("prefix").alias("token"))
    by_size = Window.partitionBy("token").orderBy("s")
    near = postings.select("token", "k", "s", F.lag("s").over(by_size).alias("before"), F.lead("s").over(by_size).alias("after"))
    shared = materialize(near.filter("s - before <= 1 or after - s <= 1").select("token", "k", "s"), "shared")
    digests = [F.bit_xor(F.xxhash64(F.lit(i), "k")).alias(f"digest_{i}") for i in range(2)]
    found = shared.groupBy("token").agg(F.count(F.lit(1)).alias("members"), *digests)
    kept = found.groupBy("members", "digest_0", "digest_1").agg(F.min("token").alias("token"), F.count(F.lit(1)).alias("copies"))
    return shared.join(kept.select("token", "copies"), "token")


def _stars(lists: DataFrame) -> DataFrame:
    """(a, b): for each class b the class a that is the smallest of a list, or of its neighbours by size in it, most often."""
    smallest = lists.groupBy("token", "s").agg(F.min("k").alias("a"))
    offered = smallest.union(smallest.select("token", (F.col("s") + 1).alias("s"), "a"))
    pairs = lists.join(offered, ["token", "s"]).filter("a <> k").groupBy("k", "a").agg(F.sum("copies").alias("n"))
    return pairs.groupBy(F.col("k").alias("b")).agg(F.max_by("a", F.struct("n", "a")).alias("a")).select("a", "b")


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes, range by range, allow the overlap."""
    side = lambda x: classes.select(F.col("k").alias(x), F.col("n").alias(f"n_{x}"), F.col("cells").alias(f"cells_{x}"))

    def task(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (4, 5))
                fits = _allows(x, y, batch.column(2).to_numpy(), batch.column(3).to_numpy(), percent)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(fits)), batch.column(1).filter(pa.array(fits))], names=["a", "b"])

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "cells_a", "cells_b")
    return both.mapInArrow(task, "a long, b long")


def _mixed_pairs(lists: DataFrame, classes: DataFrame, parts: DataFrame, percent: int, block: int, spanning: bool) -> DataFrame:
    """(a, b) of different components that share a list and may be linked; each once."""
    return _pairs_by_list(lists, classes, parts, percent, block, spanning).distinct()


def _pairs_by_list(lists: DataFrame, classes: DataFrame, parts: DataFrame, percent: int, block: int, spanning: bool) -> DataFrame:
    """(a, b) as the lists give them.

    parts: k and g, its component. A list's largest component isn't held against itself: its members meet
    the others only, block by block. spanning: only as many pairs as connect all of a pair of blocks, those
    first whose sizes by range allow the largest overlap, as they are the likeliest links and spare later pairs.
    Classes that share many lists are paired in the first of them. A row carries the first lists of its class
    alone; a pair whose first list in common is a later one may come more than once, and none is lost.
    """
    known = lists.select("token", "k").join(parts, "k", "left").select("token", "k", F.coalesce("g", "k").alias("g"))
    sizes = known.groupBy("token", "g").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("token").agg(F.count(F.lit(1)).alias("components"), F.sum("n").alias("n"), F.max(F.struct("n", "g")).alias("main")).filter("components > 1")
    mixed = mixed.select(
        "token", F.col("main.g").alias("main"), F.ceil((F.col("n") - F.col("main.n")) / block).cast("int").alias("few"), F.ceil(F.col("main.n") / block).cast("int").alias("many")
    )
    is_main = F.col("g") == F.col("main")
    own = F.when(is_main, F.col("few") + F.pmod(F.xxhash64("k"), F.col("many"))).otherwise(F.pmod(F.xxhash64("k"), F.col("few"))).cast("int")
    # lists of one component give no pairs, so a class need not carry them
    first = known.join(mixed.select("token"), "token").groupBy("k").agg(F.slice(F.sort_array(F.collect_set("token")), 1, FIRST_LISTS).alias("first"))
    placed = known.join(mixed, "token").withColumn("own", own)
    # a block of the largest component meets those of the others, these meet all
    others = F.when(is_main, F.sequence(F.lit(0), F.col("few") - 1)).otherwise(F.sequence(F.lit(0), F.col("few") + F.col("many") - 1))
    placed = placed.withColumn("other", F.explode(others)).join(classes.select("k", "n", "cells"), "k")
    placed = placed.join(first, "k").select("token", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "k", "g", "n", "cells", "first")

    def task(batches):
        out = Rows(pa.schema([("a", pa.int64()), ("b", pa.int64())]))
        for group in groups(batches, 3):
            own, k, g, n = (group.column(i).to_numpy() for i in (3, 4, 5, 6))
            cells = np.frombuffer(b"".join(group.column(7).to_pylist()), np.uint8).reshape(len(k), -1)
            hi = group.column(2)[0].as_py()
            alone = group.column(1)[0].as_py() == hi
            left = np.arange(len(k)) if alone else np.flatnonzero(own != hi)
            right = np.flatnonzero(own == hi)
            x, y = _may_overlap(left, right, k, g, n, cells, percent)
            if alone:  # a block held against itself has each pair twice
                x, y = x[x < y], y[x < y]
            here = ~_paired_before(x, y, group.column(8), group.column(0)[0].as_py())
            x, y = x[here], y[here]
            if spanning and len(x):
                order = np.argsort(-_most(x, y, n, cells), kind="stable")
                x, y = x[order], y[order]
                _, number = np.unique(g, return_inverse=True)
                edges = {}
                for i, j, p, q in zip(number[x].tolist(), number[y].tolist(), x.tolist(), y.tolist()):
                    edges.setdefault((i, j), (p, q))
                kept = forest(int(number.max()) + 1, *(np.array(e) for e in zip(*edges)))
                x, y = (np.array(e) for e in zip(*(edges[e] for e in kept)))
            if len(x):
                out.add(np.minimum(k[x], k[y]), np.maximum(k[x], k[y]))
            yield from out.take()
        yield from out.take(1)

    keys = ["token", "lo", "hi"]
    return placed.repartition(*map(F.col, keys)).sortWithinPartitions(*keys).mapInArrow(task, "a long, b long")


def _most(x: np.ndarray, y: np.ndarray, n: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """For index pairs the largest overlap that the sizes by range allow, as a share of both sizes."""
    most = np.zeros(len(x))
    for j in range(0, len(x), 20_000):
        a, b = x[j : j + 20_000], y[j : j + 20_000]
        most[j : j + 20_000] = np.minimum(cells[a], cells[b]).sum(axis=1, dtype=np.int64) / (n[a] + n[b])
    return most


def _paired_before(x: np.ndarray, y: np.ndarray, first: pa.ListArray, token: int, columns: int = 1024) -> np.ndarray:
    """Whether both rows of an index pair are in a list before this one, as far as their first lists tell."""
    found = np.zeros(len(x), bool)
    rows, tokens = np.repeat(np.arange(len(first)), first.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)), first.flatten().to_numpy()
    rows, tokens = rows[tokens < token], tokens[tokens < token]
    _, number, several = np.unique(tokens, return_inverse=True, return_counts=True)
    rows, number = rows[several[number] > 1], number[several[number] > 1]
    _, number = np.unique(number, return_inverse=True)
    for i in range(0, int(number.max(initial=-1)) + 1, columns):
        here = (number >= i) & (number < i + columns)
        known = np.zeros((len(first), columns), bool)
        known[rows[here], number[here] - i] = True
        known = np.packbits(known, axis=1)
        for j in range(0, len(x), 20_000):
            found[j : j + 20_000] |= (known[x[j : j + 20_000]] & known[y[j : j + 20_000]]).any(axis=1)
    return found


def _may_overlap(left, right, k, g, n, cells, percent: int, rows: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of different components whose sizes, range by range, allow the overlap."""
    found_x, found_y = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(0, len(left), rows):
        part = left[i : i + rows]
        x, y = np.nonzero((g[part][:, None] != g[right]) & (100 * np.minimum(n[part][:, None], n[right]) >= percent * np.maximum(n[part][:, None], n[right])))
        x, y = part[x], right[y]
        for j in range(0, len(x), 20_000):
            a, b = x[j : j + 20_000], y[j : j + 20_000]
            fits = _allows(cells[a], cells[b], n[a], n[b], percent)
            found_x.append(a[fits])
            found_y.append(b[fits])
    return np.concatenate(found_x), np.concatenate(found_y)


def _links(documents: DataFrame, classes: DataFrame, pairs: DataFrame, order, width: int, percent: int, block: int) -> DataFrame:
    """Those of the pairs (a, b) that are linked: overlaps counted by fragment, and summed."""
    sizes = classes.select(F.col("k").alias("b"), "n")
    hubs = pairs.join(sizes, "b").groupBy("a").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    place = lambda at, part, kind: F.struct(at.alias("at"), part.cast("int").alias("part"), F.lit(kind).alias("kind"))
    members = pairs.join(hubs, "a").select(F.col("b").alias("k"), place(F.col("a"), F.pmod(F.xxhash64("b"), "blocks"), 1).alias("p"))
    heads = hubs.select(F.col("a").alias("k"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part")).select("k", place(F.col("k"), F.col("part"), 0).alias("p"))
    places = materialize(members.union(heads).groupBy("k").agg(F.collect_list("p").alias("places")).join(classes.select("k", "c"), "k"), "places")

    def with_key(batches):
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(0), CHUNK):
                keys = [_class_key(s) for s in shingles(data, offsets, width)]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), batch.column(0).slice(i, j - i)], names=["k", "text"])

    def to_segments(batches):
        schema = pa.schema([("at", pa.int64()), ("part", pa.int32()), ("f", pa.int32()), ("kind", pa.int32()), ("k", pa.int64()), ("n", pa.int64()), ("segment", pa.binary())])
        known = order.value
        for batch in batches:
            out, held = Rows(schema), 0
            for i, j, data, offsets in text_chunks(batch.column(2), CHUNK):
                for row, elements in enumerate(shingles(data, offsets, width), i):
                    k, where = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                    for f, segment in known.segments(elements):
                        raw = segment.tobytes()
                        for p in where:
                            out.add([p["at"]], [p["part"]], [f], [p["kind"]], [k], [len(elements)], [raw])
                            held += len(raw)
                            if held > 1 << 22:
                                yield from out.take(1)
                                held = 0
            yield from out.take(1)

    def count(batches):
        """Partial overlaps of the head of each (at, part, f), its first row, with every other row."""
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("partial", pa.int64())])
        head, key = None, None
        for batch in batches:
            at, part, f, kind, k, n = (batch.column(i).to_numpy() for i in range(6))
            out = Rows(schema)
            cuts = np.flatnonzero((at[1:] != at[:-1]) | (part[1:] != part[:-1]) | (f[1:] != f[:-1])) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
                if i == j:
                    continue
                if key != (at[i], part[i], f[i]):
                    key, head = (at[i], part[i], f[i]), None
                if kind[i] == 0:
                    head = np.frombuffer(batch.column(6)[i].as_buffer(), np.uint64).copy(), n[i]
                    i += 1
                if head is None or i == j:
                    continue  # nothing of the head lies in this fragment
                segments = [np.frombuffer(s.as_buffer(), np.uint64) for s in batch.column(6).slice(i, j - i)]
                values = np.concatenate(segments)
                where = np.minimum(np.searchsorted(head[0], values), len(head[0]) - 1)
                shared = np.add.reduceat((head[0][where] == values).astype(np.int64), np.cumsum([0, *map(len, segments[:-1])]))
                some = np.flatnonzero(shared)
                if len(some):
                    out.add(np.full(len(some), at[i]), k[i:j][some], np.full(len(some), head[1]), n[i:j][some], shared[some])
            yield from out.take(1)

    text = documents.select(F.col("doc_id").cast("long").alias("c"), "text")
    text = mark_possible(text, "c", places.select("c")).filter("possible").select("text")
    text = text.mapInArrow(with_key, "k long, text string").filter("k is not null").groupBy("k").agg(F.min("text").alias("text"))
    keys = ["at", "part", "f"]
    partial = (
        places.join(text, "k")
        .select("k", "places", "text")
        .mapInArrow(to_segments, "at long, part int, f int, kind int, k long, n long, segment binary")
        .repartition(*map(F.col, keys))
        .sortWithinPartitions(*keys, "kind", "k")
        .mapInArrow(count, "a long, b long, n_a long, n_b long, partial long")
    )
    overlap = partial.groupBy("a", "b").agg(F.sum("partial").alias("o"), F.min("n_a").alias("n_a"), F.min("n_b").alias("n_b"))
    return overlap.filter(100 * F.col("o") >= percent * (F.col("n_a") + F.col("n_b") - F.col("o"))).select("a", "b")


def ngram_components(
    documents: DataFrame, percent: int = SIMILARITY_PERCENT, width: int = NGRAM_WORDS, fragments: int = FRAGMENTS, slot_bits: int = SLOT_BITS, block: int = BLOCK
) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``documents`` (doc_id, text; others are not read).

    Documents are linked if 100 * |intersection| >= percent * |union| of their sets of word n-grams;
    component_id is the smallest doc_id that links lead to. Rows that share a doc_id are one document, so
    they have one component, and a text without words has that of its id. A null text is empty; texts
    without words, and rows without a doc_id, are linked with nothing. A text is read whole, whatever its
    length, and an empty table gives no rows.
    """
    order = documents.sparkSession.sparkContext.broadcast(Order(_frequency_table(documents, width, slot_bits), fragments))
    signed = materialize(_prefixes(documents, order, width, percent), "prefixes")
    sets = signed.filter("k is not null and doc_id is not null")
    classes = materialize(
        sets.groupBy("k").agg(F.min("doc_id").alias("c"), F.first("n_shingles").alias("n"), F.first("prefix").alias("prefix"), F.first("cells").alias("cells")), "classes"
    )
    lists = materialize(_lists(classes, percent), "lists")
    # all texts of one id belong together
    named = sets.groupBy("doc_id").agg(F.min("k").alias("a"), F.max("k").alias("z")).filter("a < z")
    ties = sets.select("doc_id", "k").join(named.select("doc_id", "a"), "doc_id").filter("a <> k").select("a", F.col("k").alias("b")).distinct()

    def verified(pairs: DataFrame) -> DataFrame:
        return materialize(_links(documents, classes, pairs, order, width, percent, block), "links")

    tried = materialize(_possible(_stars(lists), classes, percent), "tried")
    links = verified(tried).union(materialize(ties, "ties"))
    for spanning in (True, False):
        parts = connected_components(links).select(F.col("node").alias("k"), F.col("component").alias("g"))
        pairs = materialize(_mixed_pairs(lists, classes, parts, percent, block, spanning), "pairs")
        new = materialize(pairs.join(tried.union(tried.select("b", "a")), ["a", "b"], "left_anti"), "new")
        found = verified(new)
        links, tried = links.union(found), tried.union(new)
        if pairs.count() == found.count():
            break  # all of them are links, and they connect all that may be linked

    parts = connected_components(links).select(F.col("node").alias("k"), F.col("component").alias("g"))
    member = classes.select("k", "c").join(parts, "k", "left").select("k", "c", F.coalesce("g", "k").alias("g"))
    smallest = member.groupBy("g").agg(F.min("c").alias("component"))
    of_doc = member.join(smallest, "g").join(sets.select("doc_id", "k").distinct(), "k").groupBy("doc_id").agg(F.min("component").alias("component"))
    return signed.select("doc_id", "n_shingles").join(of_doc, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
