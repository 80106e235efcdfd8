"""Conversation prefix trie: one node for each distinct beginning of a conversation.

1. A streaming pass gives every turn a key, the digest of the conversation up to and with it. Equal
   keys are the same node. Equal conversations become one sequence with a weight.
2. The tree is cut into prefix shards. A node with more than ``limit`` rows below it lies above the
   cut; what hangs from it and is smaller is a shard's own subtree, so shards are of bounded size
   however many conversations share a beginning, and no node below the cut is in two shards.
3. A shard numbers its turns densely and packs its sequences into a double array: a child of node s by
   turn c is at BASE[s] + c, and CHECK there is s. Sequences are walked through the arrays, a step for
   all of them at once, and leave their weights in the nodes; sums over subtrees go up by depth.
4. Nodes above the cut are shared by shards. Their own figures are sums by key, and what is below them
   is the merged total of the shards that hang from them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.llm.tasks import groups
from shelfwise.session import materialize

#: Rows of distinct sequences that a shard's own subtree holds at most.
SHARD_ROWS = 200_000
#: A conversation begins with turns of the one whose id is the next lower multiple of this ...
TEMPLATE_STEP = 20
#: ... fewer than so many of them.
TEMPLATE_TURNS = 4
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_ROOT = hashlib.blake2b(b"", digest_size=16).digest()
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), role, text; a missing turn first, equal turns by role, then text."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).filter("conv_id is not null")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.select("conv_id", (F.row_number().over(order) - 1).alias("place"), "role", "text")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of the rebuilt conversations, their ids): conv_id, own, place, role, text; and conv_id.

    Conversation c is the first h turns of conversation c - c % 20, then its own turns after its first
    h, where h is the CRC-32 of c in decimal, modulo 4. Rows without a conv_id take no part.
    """
    rows = _numbered(conversations)
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).filter("conv_id is not null").distinct()
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(TEMPLATE_TURNS))
    own = rows.filter(F.col("place") >= taken).select("conv_id", F.lit(1).alias("own"), "place", "role", "text")
    heads = rows.filter((F.col("conv_id") % TEMPLATE_STEP == 0) & (F.col("place") < TEMPLATE_TURNS - 1)).withColumnRenamed("conv_id", "template")
    copied = (
        ids.withColumn("template", F.col("conv_id") - F.col("conv_id") % TEMPLATE_STEP)
        .join(heads, "template")
        .filter(F.col("place") < taken)
        .select("conv_id", F.lit(0).alias("own"), "place", "role", "text")
    )
    return own.union(copied), ids


def keyed_turns(rows: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), key, parent, turn (16-byte digests), words, last (whether the conversation ends).

    A conversation passes as a stream of rows.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()), ("parent", pa.binary()), ("turn", pa.binary()), ("words", pa.int64()), ("last", pa.bool_())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, depth, parent = None, 0, _ROOT
        for batch in batches:
            out = []
            for conv_id, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                same = held is not None and held[0] == conv_id
                if held is not None:
                    out.append((*held, not same))
                if not same:
                    depth, parent = 0, _ROOT
                said, who = text.encode("utf-8", "surrogatepass"), role.encode("utf-8", "surrogatepass")
                turn = hashlib.blake2b(len(who).to_bytes(8, "little") + who + said, digest_size=16).digest()
                key = hashlib.blake2b(parent + turn, digest_size=16).digest()
                depth += 1
                held = (conv_id, depth, key, parent, turn, len(_WORD.findall(text)))
                parent = key
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((*held, True), schema)], schema=schema)

    ordered = rows.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "own", "place").select("conv_id", "role", "text")
    return ordered.mapInArrow(task, "conv_id long, depth long, key binary, parent binary, turn binary, words long, last boolean")


class DoubleArray:
    """A trie in two arrays: the child of node s by symbol c is t = base[s] + c if check[t] = s. The root is 0.

    Nodes are placed level by level: those with several children first, at the first offset at which all of
    these fall on free slots; only children then take the free slots one after another.
    """

    def __init__(self, lengths: np.ndarray, symbols: np.ndarray):
        """symbols: those of all sequences, one after another; lengths: how many each has."""
        first = np.cumsum(lengths) - lengths
        self.base = np.zeros(1, np.int64)
        self.check = np.zeros(1, np.int64)
        self._free = 1
        alive = np.flatnonzero(lengths > 0)
        at, depth = np.zeros(len(lengths), np.int64), 0
        while len(alive):
            c, s = symbols[first[alive] + depth], at[alive]
            order = np.lexsort((c, s))
            s, c = s[order], c[order]
            new = np.r_[True, (s[1:] != s[:-1]) | (c[1:] != c[:-1])]
            parents, children = s[new], c[new]
            heads = np.flatnonzero(np.r_[True, parents[1:] != parents[:-1]])
            self._place(parents, children, heads, np.diff(np.r_[heads, len(parents)]))
            at[alive] = self.step(at[alive], symbols[first[alive] + depth])
            depth += 1
            alive = alive[lengths[alive] > depth]

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _place(self, parents: np.ndarray, children: np.ndarray, heads: np.ndarray, sizes: np.ndarray) -> None:
        several = sizes > 1
        for i, n in zip(heads[several].tolist(), sizes[several].tolist()):
            offsets = children[i : i + n] - children[i]
            start = self._free
            self._grow(start + int(offsets[-1]) + 257)
            while True:
                window = start + np.flatnonzero(self.check[start : start + 256] < 0)
                window = window[window + offsets[-1] < len(self.check)]
                if not len(window):
                    start += 256
                    self._grow(start + int(offsets[-1]) + 257)
                    continue
                fits = np.ones(len(window), bool)
                for offset in offsets[1:].tolist():
                    fits &= self.check[window + offset] < 0
                    if not fits.any():
                        break
                if fits.any():
                    slot = int(window[np.argmax(fits)])
                    break
                start = int(window[-1]) + 1
            self.base[parents[i]] = slot - children[i]
            self.check[slot + offsets] = parents[i]
            self._skip()
        single = heads[sizes == 1]
        if len(single):
            free = self._free + np.flatnonzero(self.check[self._free :] < 0)[: len(single)]
            if len(free) < len(single):
                self._grow(len(self.check) + len(single))
                free = self._free + np.flatnonzero(self.check[self._free :] < 0)[: len(single)]
            self.base[parents[single]] = free - children[single]
            self.check[free] = parents[single]
            self._skip()

    def _skip(self) -> None:
        """Moves the first free slot on."""
        while self._free < len(self.check):
            open_ = np.flatnonzero(self.check[self._free : self._free + 4096] < 0)
            if len(open_):
                self._free += int(open_[0])
                return
            self._free += 4096
        self._free = len(self.check)

    def step(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Children of nodes by symbols; -1 where there is none."""
        there = self.base[nodes] + symbols
        inside = (there > 0) & (there < len(self.check))
        found = inside & (self.check[np.where(inside, there, 0)] == nodes)
        return np.where(found, there, -1)


def shard_nodes(conv: np.ndarray, top: np.ndarray, turn: np.ndarray, words: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Nodes of one shard, from rows sorted by (conv, depth), with a row of each that stands for it.

    top, turn: numbers of the node at which the row's sequence enters the shard, and of its turn; dense, in
    the order of first use, so that turns that follow one another have numbers close by. Returns row (an index into
    the given rows), parent_row (-1 for a top), conv_id, n_convs, n_children, n_leaves, saved.
    """
    starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
    lengths = np.diff(np.r_[starts, len(conv)])
    symbols = turn.astype(np.int64)
    symbols[starts] = top[starts]
    trie = DoubleArray(lengths, symbols)

    size = len(trie.check)
    row = np.full(size, -1, np.int64)
    smallest = np.full(size, np.iinfo(np.int64).max)
    convs, at, alive, step = np.zeros(size, np.int64), np.zeros(len(starts), np.int64), np.arange(len(starts)), 0
    levels = []
    while len(alive):
        rows = starts[alive] + step
        at[alive] = trie.step(at[alive], symbols[rows])
        nodes = at[alive]
        row[nodes] = rows
        np.add.at(convs, nodes, weight[rows])
        np.minimum.at(smallest, nodes, conv[rows])
        levels.append(np.unique(nodes))
        step += 1
        alive = alive[lengths[alive] > step]
    children, leaves, saved = (np.zeros(size, np.int64) for _ in range(3))
    for nodes in reversed(levels):
        leaves[nodes] += children[nodes] == 0
        saved[nodes] += (convs[nodes] - 1) * words[row[nodes]]
        parents = trie.check[nodes]
        np.add.at(children, parents, 1)
        np.add.at(leaves, parents, leaves[nodes])
        np.add.at(saved, parents, saved[nodes])
    nodes = np.concatenate(levels)
    parents = trie.check[nodes]
    return {
        "row": row[nodes], "parent_row": np.where(parents > 0, row[parents], -1), "conv_id": smallest[nodes],
        "parent_conv": np.where(parents > 0, smallest[parents], -1), "n_convs": convs[nodes], "n_children": children[nodes],
        "n_leaves": leaves[nodes], "saved": saved[nodes],
    }


def _lower_nodes(rows: DataFrame) -> DataFrame:
    """key, parent, depth, conv_id, parent_conv_id (null for a top), n_convs, n_children, n_leaves, saved_tokens of all shards.

    rows: shard, conv_id, depth, key, parent, top, turn, words, weight.
    """
    schema = pa.schema(
        [("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()),
         ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64())]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, 1):
            column = {n: group.column(i) for i, n in enumerate(group.schema.names)}
            numbers = {n: column[n].to_numpy() for n in ("conv_id", "depth", "words", "weight")}
            top, turn = (column[n].dictionary_encode().indices.to_numpy() for n in ("top", "turn"))
            made = shard_nodes(numbers["conv_id"], top, turn, numbers["words"], numbers["weight"])
            for i in range(0, len(made["row"]), 20_000):
                part = {n: v[i : i + 20_000] for n, v in made.items()}
                at = pa.array(part["row"])
                yield pa.RecordBatch.from_arrays(
                    [column["key"].take(at), column["parent"].take(at), pa.array(numbers["depth"][part["row"]]), pa.array(part["conv_id"]),
                     pa.array(part["parent_conv"], mask=part["parent_row"] < 0), pa.array(part["n_convs"]), pa.array(part["n_children"]),
                     pa.array(part["n_leaves"]), pa.array(part["saved"])],
                    schema=schema,
                )

    ordered = rows.select("shard", "conv_id", "depth", "key", "parent", "top", "turn", "words", "weight")
    ordered = ordered.repartition(F.col("shard")).sortWithinPartitions("shard", "conv_id", "depth")
    return ordered.mapInArrow(task, "key binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")


def _ends(ends: DataFrame) -> DataFrame:
    """key, ends_sha256: the ids of the conversations that end at a node, ascending, read as a stream."""
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])

    def task(batches):
        open_, digest = None, None
        for batch in batches:
            out = []
            for key, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != open_:
                    if open_ is not None:
                        out.append((open_, digest.hexdigest()))
                    open_, digest = key, hashlib.sha256(str(conv_id).encode())
                else:
                    digest.update(b",%d" % conv_id)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if open_ is not None:
            yield pa.RecordBatch.from_arrays([pa.array([open_], pa.binary()), pa.array([digest.hexdigest()])], schema=schema)

    return ends.select("key", "conv_id").repartition(F.col("key")).sortWithinPartitions("key", "conv_id").mapInArrow(task, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, limit: int = SHARD_ROWS) -> DataFrame:
    """The nodes of all rebuilt conversations (conv_id, turn, role, text; other columns are not read).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. A null role or text is empty; rows without a conv_id take no part; rows with equal turns
    are taken by role, then text, and repeated rows count. Turns of any length pass as a stream. A table
    without conversations has no nodes, not even the root.
    """
    rows, ids = rebuilt(conversations)
    turns = materialize(keyed_turns(rows), "turns")
    root = F.lit(bytearray(_ROOT))
    # the end of each conversation, which is the root for one without turns
    ends = materialize(
        ids.join(turns.filter("last").select("conv_id", "key", "depth"), "conv_id", "left").select(
            "conv_id", F.coalesce("key", root).alias("key"), F.coalesce("depth", F.lit(0)).alias("length")
        ),
        "ends",
    )
    # equal conversations end at one node: one sequence, the smallest id's, with their number as weight
    sequences = ends.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.first("length").alias("length"))
    sequences = materialize(sequences.drop("key"), "sequences")
    at_root = sequences.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), root.alias("key"), F.lit(None).cast("binary").alias("parent"),
        F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("long").alias("words"), "weight", "length",
    )
    paths = turns.drop("last").join(sequences, "conv_id").select(at_root.columns)
    paths = materialize(paths.union(at_root), "paths")

    # above the cut: the root, and nodes with more than ``limit`` rows in their subtree
    upper = paths.groupBy("key").agg(F.sum(F.col("length") - F.col("depth") + 1).alias("rows")).filter((F.col("rows") > limit) | (F.col("key") == root))
    shared = materialize(paths.join(upper.select("key"), "key", "left_semi"), "shared")
    cut = shared.groupBy("conv_id").agg(F.max("depth").alias("cut"))
    below = paths.join(cut, "conv_id").filter(F.col("depth") > F.col("cut"))
    tops = below.filter(F.col("depth") == F.col("cut") + 1).select("conv_id", F.col("key").alias("top"))
    shards = F.lit(-(-(below.count() or 1) // limit)).cast("long")
    lower = _lower_nodes(below.join(tops, "conv_id").withColumn("shard", F.pmod(F.xxhash64("top"), shards)))
    lower = materialize(lower, "lower")

    # shared nodes: their own figures by key, then what hangs from them
    own = shared.groupBy("key").agg(
        F.first("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.max("words").alias("words")
    )
    hung = lower.filter("parent_conv_id is null").groupBy("parent").agg(
        F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
    )
    inner = own.filter("parent is not null").groupBy("parent").agg(F.count(F.lit(1)).alias("n_inner"))
    own = (
        own.join(hung.withColumnRenamed("parent", "key"), "key", "left")
        .join(inner.withColumnRenamed("parent", "key"), "key", "left")
        .na.fill(0, ["n_children", "n_leaves", "saved_tokens", "n_inner"])
        .withColumn("n_children", F.col("n_children") + F.col("n_inner"))
        .withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long"))
        .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words"))
    )
    own = materialize(own.drop("words", "n_inner"), "upper")
    # each shared node adds its total to itself and to the shared nodes on the way to it
    ways = shared.select("conv_id", F.col("depth").alias("above"), F.col("key").alias("to"))
    merged = own.join(ways, "conv_id").filter(F.col("above") <= F.col("depth")).groupBy(F.col("to").alias("key")).agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
    )
    names = own.select(F.col("key").alias("parent"), F.col("conv_id").alias("named"))
    upper_nodes = own.drop("n_leaves", "saved_tokens").join(merged, "key")
    nodes = upper_nodes.withColumn("parent_conv_id", F.lit(None).cast("long")).unionByName(lower).join(names, "parent", "left")
    return nodes.join(_ends(ends), "key", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "named").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
