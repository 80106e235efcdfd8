"""Training-order materialisation: token sequences in fixed-stride shards, by a keyed permutation.

Texts become sequences of ``length`` token ids (the last one padded), numbered in the order of the
input splits. A Feistel permutation of the numbers, cycle-walked onto their exact range, gives each
sequence its slot; no table of the permutation exists. Slots are dealt in ranges to shards. In a
shard every record takes the same number of bytes, so a reader starts at any slot by one seek.

The numbers follow the splits of the input: the same files and split size give the same order. Texts
are encoded twice, once to count the sequences of each split and once to place them: that costs less
than keeping the ids of the whole corpus on disk beside the shuffle and the shards.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm.tasks import changes
from shelfwise.llm.texts import mix
from shelfwise.llm.tokens import RANKS_FILE, Encoder
from shelfwise.session import materialize

LENGTH = 256
SHARD_RECORDS = 8192
ROUNDS = 6
#: Documents whose records are built at a time.
ROWS = 500
#: Before the ids of a record: document, part of it, ids in use.
HEADER = np.dtype([("doc_id", "<i8"), ("part", "<i4"), ("n_tokens", "<i4")])


def permuted(numbers: np.ndarray, size: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """Slots 0..size-1 of the numbers 0..size-1: a bijection that ``key`` picks."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) + mix(np.array([key % 2**64], np.uint64)))

    def once(x):
        left, right = x >> shift, x & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        return left << shift | right

    slots = once(numbers.astype(np.uint64))
    out = np.flatnonzero(slots >= size)
    while len(out):  # walk on along the cycle until it is back in the range
        slots[out] = once(slots[out])
        out = out[slots[out] >= size]
    return slots.astype(np.int64)


def _record(length: int) -> np.dtype:
    return np.dtype([*((name, HEADER[name]) for name in HEADER.names), ("ids", "<u2", (length,))])


def _records(encoder: Encoder, doc_id: int, text: str, length: int) -> np.ndarray:
    """The records of a text: its ids, an end id last, the last record padded with that id."""
    ids = array("H", encoder.encode(text))
    n = len(ids) // length + 1
    made = np.empty(n, _record(length))
    made["doc_id"], made["part"], made["n_tokens"] = doc_id, np.arange(n), length
    made["n_tokens"][-1] = len(ids) + 1 - (n - 1) * length
    padded = np.full(n * length, encoder.end, "<u2")
    padded[: len(ids)] = ids
    made["ids"] = padded.reshape(n, length)
    return made


def _binary(records: np.ndarray) -> pa.Array:
    """One binary value for each record."""
    ends = np.arange(len(records) + 1, dtype=np.int32) * np.int32(records.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(records), [None, pa.py_buffer(ends), pa.py_buffer(records.tobytes())])


def _split_sizes(rows: DataFrame, length: int, ranks_file: str) -> dict[int, int]:
    """Sequences of each input split: one number for each."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, total = Encoder.load(ranks_file), 0
        for batch in batches:
            total += sum(len(encoder.encode(t.as_py() or "")) // length + 1 for t in batch.column(1))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total], pa.int64())], names=["split", "n"])

    return {r["split"]: r["n"] for r in rows.mapInArrow(task, "split int, n long").collect()}


def write_shards(
    documents: DataFrame,
    path: str,
    key: int = 0,
    length: int = LENGTH,
    shard_records: int = SHARD_RECORDS,
    ranks_file: str = RANKS_FILE,
) -> DataFrame:
    """Write all texts of ``documents`` (doc_id, text; others unused) below ``path``; shard, file, records.

    Every row is written, repeated ones too; a null doc_id is -1, a null or empty text is its end id
    alone. A shard appears under its name only when it is complete, so a lost task is just run again.
    The vocabulary must fit 16 bits.
    """
    spark = documents.sparkSession
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc_id"), "text")
    sizes = _split_sizes(rows, length, ranks_file)
    order = sorted(sizes)
    bases = dict(zip(order, np.concatenate([[0], np.cumsum([sizes[s] for s in order])]).tolist()))
    size = sum(sizes.values())
    stride = HEADER.itemsize + 2 * length
    pad = Encoder.load(ranks_file).end

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, split = Encoder.load(ranks_file), TaskContext.get().partitionId()
        at = bases[split]
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                named = zip(part.column(0).to_pylist(), part.column(1))
                records = np.concatenate([_records(encoder, doc_id, text.as_py() or "", length) for doc_id, text in named])
                slots = permuted(np.arange(at, at + len(records)), size, key)
                at += len(records)
                yield pa.RecordBatch.from_arrays([pa.array(slots // shard_records), pa.array(slots), _binary(records)], names=["shard", "slot", "record"])
        if at != bases[split] + sizes[split]:
            raise RuntimeError("the input was split otherwise when its sequences were counted")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(path)
        store.create_dir(root, recursive=True)
        open_, stream, count, done = None, None, 0, []
        attempt = TaskContext.get().taskAttemptId()

        def close():
            if stream is not None:
                stream.close()
                store.move(f"{root}/.{open_}-{attempt}", f"{root}/{_name(open_)}")
                done.append((open_, _name(open_), count))

        for batch in filter(len, batches):
            numbers, (_, ends, data) = batch.column(0).to_numpy(), batch.column(1).buffers()
            ends = np.frombuffer(ends, np.int32)[batch.column(1).offset :]
            cuts = [0, *changes(batch, 1).tolist(), batch.num_rows]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if numbers[i] != open_:
                    close()
                    open_, count = int(numbers[i]), 0
                    stream = store.open_output_stream(f"{root}/.{open_}-{attempt}")
                stream.write(data[int(ends[i]) : int(ends[j])])
                count += j - i
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done), (pa.int64(), pa.string(), pa.int64()))], names=["shard", "file", "records"])

    dealt = (
        rows.mapInArrow(place, "shard long, slot long, record binary")
        .repartition(F.col("shard"))
        .sortWithinPartitions("shard", "slot")
        .select("shard", "record")
    )
    shards = materialize(dealt.mapInArrow(write, "shard long, file string, records long"), "shards")
    store, root = _store(path)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/manifest.json") as out:
        out.write(json.dumps({"length": length, "stride": stride, "shard_records": shard_records, "records": size, "pad": pad, "key": key}).encode())
    return shards


def _name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def _store(path: str):
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return store, root.rstrip("/")


def read_records(path: str, start: int = 0, stop: int | None = None) -> Iterator[tuple[int, np.void, np.ndarray]]:
    """(slot, record, ids in use) of the slots from start on, in order: what a trainer reads, also after a break."""
    store, root = _store(path)
    with store.open_input_stream(f"{root}/manifest.json") as file:
        manifest = json.loads(file.read())
    length, stride, per = manifest["length"], manifest["stride"], manifest["shard_records"]
    stop = manifest["records"] if stop is None else min(stop, manifest["records"])
    slot = start
    while slot < stop:
        shard = slot // per
        with store.open_input_file(f"{root}/{_name(shard)}") as file:
            file.seek((slot - shard * per) * stride)
            end = min(stop, (shard + 1) * per)
            while slot < end:
                for record in np.frombuffer(file.read(stride * min(1024, end - slot)), _record(length)):
                    yield slot, record, record["ids"][: record["n_tokens"]]
                    slot += 1


def read_shards(spark: SparkSession, shards: DataFrame, path: str, shard_records: int = SHARD_RECORDS) -> DataFrame:
    """slot, doc_id, part, n_tokens, crc32 (of the ids in use) of every record, each shard read by one task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                found = [
                    (slot, int(h["doc_id"]), int(h["part"]), int(h["n_tokens"]), zlib.crc32(ids.tobytes()))
                    for slot, h, ids in read_records(path, shard * shard_records, (shard + 1) * shard_records)
                ]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*found), types)], names=["slot", "doc_id", "part", "n_tokens", "crc32"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return shards.select("shard").repartition(parts).mapInArrow(task, "slot long, doc_id long, part int, n_tokens int, crc32 long")
