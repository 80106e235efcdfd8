"""Removal of long repeated byte strings by suffix sorting.

1. Every window of ``length`` bytes belongs to the smallest hash among its ``gram``-byte strings, so
   equal windows belong to the same hash, wherever they stand. Neighbouring windows with the same
   smallest string make one piece of text, of less than twice the length. Pieces whose hash occurs
   once in the corpus are left out.
2. The other pieces go to the task of their hash. There the pieces are sorted as suffixes in two
   stages, a bounded amount of text at a time, and neighbours with a common prefix of ``length``
   bytes are repeated windows. Equal pieces are merged first (a passage that a third of the
   documents share is one row for each batch of a task), and a hash with more than ``hot`` pieces
   is split by the smallest hash among longer strings of its windows.
3. Repeated windows go back to their documents as spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.idsets import mark_possible
from shelfwise.llm.suffixes import adjacent_prefixes, eight_bytes, two_stage_order
from shelfwise.llm.tasks import Rows
from shelfwise.llm.texts import as_bytes, mix, prefix_hashes, release, span_hashes, text_chunks
from shelfwise.session import materialize

LENGTH = 200
#: Pieces of one hash in a task before they are split further.
HOT_PIECES = 20_000
#: Bytes that are sorted together.
SORT_BYTES = 500_000


def _gram(length: int) -> int:
    return max(1, length * 8 // 25)


def _window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` values in a row."""
    if len(x) < width:
        return x[:0]
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: len(x) - width + 1], ahead[width - 1 : len(x)])


def pieces(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, first window, last window, hash) of each piece of the rows' windows, in order."""
    none = np.zeros(0, np.int64)
    gram = _gram(length)
    if len(data) < length:
        return none, none, none, none.astype(np.uint64)
    h = prefix_hashes(data)
    at = np.arange(len(data) - gram + 1)
    grams = span_hashes(h, at, at + gram)
    bits = max(21, int(len(data)).bit_length())
    # the leftmost of equal smallest strings: the place takes the low bits
    minima = _window_minima((grams >> np.uint64(bits) << np.uint64(bits)) | at.astype(np.uint64), length - gram + 1)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    windows = np.flatnonzero(owner[: len(data) - length + 1] == owner[length - 1 :])
    if not len(windows):
        return none, none, none, none.astype(np.uint64)
    least = minima[windows]
    heads = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    lasts = np.r_[heads[1:], len(windows)] - 1
    place = (least[heads] & np.uint64((1 << bits) - 1)).astype(np.int64)
    return owner[windows[heads]], windows[heads], windows[lasts], grams[place]


def _keyed(documents: DataFrame) -> DataFrame:
    """The text with a key of its row: rows with equal keys have the same text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("_a"), F.xxhash64(text).alias("_b"), text.alias("_text"))


def _piece_hashes(keyed: DataFrame, length: int) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, _, data, offsets in text_chunks(batch.column(2)):
                row, _, _, key = pieces(data, offsets, length)
                yield pa.RecordBatch.from_arrays([pa.array(a[i + row]), pa.array(b[i + row]), pa.array(key.view(np.int64))], names=["_a", "_b", "h"])

    return keyed.mapInArrow(task, "_a long, _b long, h long")


def _shares(prefix: np.ndarray, first: int, last: int, length: int, shares: int) -> np.ndarray:
    """Which of ``shares`` parts of its hash each window first..last goes to; equal windows go to the same.

    The smallest hash among the window's strings of nearly its length decides, so neighbours mostly stay
    together. The more parts, the longer the strings, up to the window itself: a string that very many
    documents share with different neighbours does not hold them together.
    """
    width = max(1, (length - _gram(length) + 1) // shares)
    start = np.arange(first, last + width)
    return (_window_minima(mix(span_hashes(prefix, start, start + length - width + 1)), width) % np.uint64(shares)).astype(np.int64)


_PIECE = pa.schema(
    [("h", pa.int64()), ("p", pa.int64()), ("q", pa.int64()), ("n", pa.int32()), ("piece", pa.binary()), ("_a", pa.int64()), ("_b", pa.int64()), ("at", pa.list_(pa.int32()))]
)


def _cut_pieces(wanted: DataFrame, length: int, hot: int) -> DataFrame:
    """The pieces of the hashes listed for each row: h, (p, q) naming its bytes, n, piece, _a, _b, and at, where it stands in the row.

    Of equal pieces in a batch the first holds the bytes and their number n; the others have none.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            known, often = batch.column(3), batch.column(4)
            out: list[list] = [[] for _ in _PIECE]
            seen: dict[tuple[int, int], int] = {}
            for i, _, data, offsets in text_chunks(batch.column(2)):
                row, first, last, key = pieces(data, offsets, length)
                bounds = np.searchsorted(row, np.arange(len(offsets)))
                prefix = None
                for r in range(len(offsets) - 1):
                    x, y = bounds[r], bounds[r + 1]
                    if x == y:
                        continue
                    listed = known[i + r].values.to_numpy().view(np.uint64)
                    counts = often[i + r].values.to_numpy()
                    by = np.argsort(listed)
                    at = by[np.minimum(np.searchsorted(listed[by], key[x:y]), len(by) - 1)]
                    hit = np.flatnonzero(listed[at] == key[x:y])
                    own: dict[tuple[int, int], list[int]] = {}
                    for k in hit.tolist():
                        h, s, e, n = int(key[x + k].view(np.int64)), int(first[x + k]), int(last[x + k]), int(counts[at[k]])
                        if n <= hot:
                            parts = [(h, s, e)]
                        else:
                            if prefix is None:
                                prefix = prefix_hashes(data)
                            share = _shares(prefix, s, e, length, -(-n // hot))
                            cuts = np.flatnonzero(np.r_[True, share[1:] != share[:-1], True]).tolist()
                            parts = [
                                (int(mix(np.array([h], np.int64).view(np.uint64) + np.uint64(1 + share[c]))[0].view(np.int64)), s + c, s + d - 1)
                                for c, d in zip(cuts[:-1], cuts[1:])
                            ]
                        for h, s, e in parts:
                            body = data[s : e + length].tobytes()
                            name = hashlib.blake2b(body, digest_size=16).digest()
                            p, q = int.from_bytes(name[:8], "little", signed=True), int.from_bytes(name[8:], "little", signed=True)
                            known_at = seen.get((p, q))
                            if known_at is None:
                                seen[p, q] = len(out[0])
                            else:
                                out[3][known_at] += 1
                                body = None
                            if (p, q) in own:
                                own[p, q].append(s - int(offsets[r]))
                                continue
                            own[p, q] = [s - int(offsets[r])]
                            for column, value in zip(out, (h, p, q, 1, body, a[i + r], b[i + r], own[p, q])):
                                column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _PIECE)], schema=_PIECE)

    return wanted.mapInArrow(task, "h long, p long, q long, n int, piece binary, _a long, _b long, at array<int>")


def repeated_windows(texts: list[bytes], copies: list[int], length: int) -> list[np.ndarray]:
    """For each text the starts of its windows that occur twice, in it, in another one or in a copy of it."""
    sizes = np.array([len(t) for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    owner = np.repeat(np.arange(len(texts)), sizes)
    wanted = np.zeros(len(data), bool)
    wanted[: max(0, len(data) - length + 1)] = owner[: max(0, len(data) - length + 1)] == owner[length - 1 :]
    words = eight_bytes(data, length + 8)
    ends = np.minimum(np.arange(len(data)) + length, len(data))
    same = span_hashes(prefix_hashes(data), np.arange(len(data)), ends)
    order = two_stage_order(data, wanted, length, same, words)
    long = adjacent_prefixes(words, order, length) >= length
    repeated = np.zeros(len(data), bool)
    repeated[order[:-1][long]] = True
    repeated[order[1:][long]] = True
    found = []
    for i, n in enumerate(copies):
        starts = np.flatnonzero((wanted if n > 1 else repeated)[offsets[i] : offsets[i + 1]])
        found.append(starts)
    return found


def spans(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the byte runs that windows at sorted starts cover."""
    if not len(starts):
        return starts, starts
    gap = np.flatnonzero(starts[1:] > starts[:-1] + length)
    return starts[np.r_[0, gap + 1]], starts[np.r_[gap, len(starts) - 1]] + length


def _sorted_spans(unique: DataFrame, length: int, sort_bytes: int) -> DataFrame:
    """p, q, from, to: for each piece with repeated windows the byte runs they cover in it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(pa.schema([("p", pa.int64()), ("q", pa.int64()), ("from", pa.list_(pa.int32())), ("to", pa.list_(pa.int32()))]))
        names: list[tuple[int, int]] = []
        texts: list[bytes] = []
        copies: list[int] = []
        held, last = 0, None

        def flush():
            p, q, begin, end = [], [], [], []
            for name, starts in zip(names, repeated_windows(texts, copies, length) if len(texts) > 1 or copies != [1] else [[]]):
                if len(starts):
                    s, e = spans(starts, length)
                    p.append(name[0])
                    q.append(name[1])
                    begin.append(s)
                    end.append(e)
            if p:
                out.add(p, q, begin, end)
            names.clear(), texts.clear(), copies.clear()

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for h, p, q, n, piece in zip(*columns):
                if names and names[-1] == (p, q):
                    copies[-1] += n
                    continue
                if h != last and held >= sort_bytes:
                    flush()
                    yield from out.take()
                    held = 0
                last = h
                names.append((p, q))
                texts.append(piece)
                copies.append(n)
                held += len(piece)
        if names:
            flush()
        yield from out.take(1)
        release()

    placed = unique.repartition(F.col("h")).sortWithinPartitions("h", "p", "q")
    return placed.mapInArrow(task, "p long, q long, `from` array<int>, `to` array<int>")


def repeated_spans(documents: DataFrame, length: int = LENGTH, hot: int = HOT_PIECES, sort_bytes: int = SORT_BYTES) -> DataFrame:
    """_a, _b, spans: for each row of ``documents`` with repeated windows the byte runs they cover, unmerged."""
    keyed = _keyed(documents)
    hashes = _piece_hashes(keyed, length)
    often = hashes.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # many pieces come from a row, and lists are stored as small files: Spark takes these tables for smaller than they are
    # and would broadcast them, so they meet in merge joins
    listed = hashes.join(often.hint("merge"), "h").groupBy("_a", "_b").agg(F.collect_set(F.struct("h", "n")).alias("x"))
    listed = materialize(listed.select("_a", "_b", F.col("x.h").alias("hs"), F.col("x.n").alias("ns")), "repeated-hashes")
    texts = _only(keyed, listed).join(listed.hint("merge"), ["_a", "_b"]).select("_a", "_b", "_text", "hs", "ns")
    cut = materialize(_cut_pieces(texts, length, hot), "pieces")

    def moved(at):
        return F.transform(F.arrays_zip("from", "to"), lambda x: F.struct((x["from"] + at).alias("s"), (x["to"] + at).alias("e")))

    found = _sorted_spans(cut.filter("piece is not null").select("h", "p", "q", "n", "piece"), length, sort_bytes)
    return (
        cut.select("p", "q", "_a", "_b", "at")
        .join(found.hint("merge"), ["p", "q"])
        .select("_a", "_b", F.flatten(F.transform("at", moved)).alias("x"))
        .groupBy("_a", "_b")
        .agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("x")))).alias("spans"))
    )


def _key(df: DataFrame) -> DataFrame:
    return df.withColumn("_k", F.xxhash64("_a", "_b"))


def _only(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows that may have a key among ``keys``."""
    return mark_possible(_key(rows), "_k", _key(keys).select("_k")).filter("possible").drop("possible", "_k")


def with_spans(documents: DataFrame, length: int = LENGTH, hot: int = HOT_PIECES, sort_bytes: int = SORT_BYTES) -> DataFrame:
    """``documents`` with _froms and _tos, the byte runs to remove (null: none); only texts that have some move."""
    found = materialize(repeated_spans(documents, length, hot, sort_bytes).select("_a", "_b", F.col("spans.s").alias("_froms"), F.col("spans.e").alias("_tos")), "spans")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.withColumns({"_a": F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)), "_b": F.xxhash64(text)})
    marked = mark_possible(_key(rows), "_k", _key(found).select("_k")).drop("_k")
    moved = marked.filter("possible").join(found.hint("merge"), ["_a", "_b"], "left").drop("possible", "_a", "_b")
    none = F.lit(None).cast("array<int>")
    still = marked.filter("not possible").drop("possible", "_a", "_b").withColumns({"_froms": none, "_tos": none})
    return still.union(moved)


def _kept(text: np.ndarray, froms, tos) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, runs removed)"""
    if froms is None or not len(froms):
        return text.tobytes(), 0, 0
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, froms, 1)
    np.add.at(edge, tos, -1)
    gone = np.cumsum(edge[:-1]) > 0
    return text[~gone].tobytes(), int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())


def _each(batch: pa.RecordBatch, text: int, froms: int, tos: int):
    data, offsets = as_bytes(batch.column(text))
    for r in range(batch.num_rows):
        begin, end = batch.column(froms)[r], batch.column(tos)[r]
        span = (begin.values.to_numpy(), end.values.to_numpy()) if begin.is_valid else (None, None)
        yield _kept(data[offsets[r] : offsets[r + 1]], *span)


def repeat_report(documents: DataFrame, length: int = LENGTH, hot: int = HOT_PIECES, sort_bytes: int = SORT_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row of ``documents`` (doc_id, text; others unused).

    A byte is removed if a string of ``length`` bytes that covers it starts anywhere else in the
    corpus too, in UTF-8; all occurrences go. A null text is empty. Rows count as documents of
    their own even if they share a doc_id or are equal; a null doc_id stays null.
    """
    rows = with_spans(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), length, hot, sort_bytes)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, runs, digest = [], [], [], []
            for left, gone, n in _each(batch, 1, 2, 3):
                kept.append(len(left) + gone)
                removed.append(gone)
                runs.append(n)
                digest.append(hashlib.sha256(left).hexdigest())
            columns = [batch.column(0), pa.array(kept, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digest, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.select("doc_id", "text", "_froms", "_tos").mapInArrow(task, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(documents: DataFrame, length: int = LENGTH, hot: int = HOT_PIECES, sort_bytes: int = SORT_BYTES) -> DataFrame:
    """``documents`` with the repeated strings cut out of ``text``; all rows and columns stay.

    Where a cut goes through a character of several bytes, what is left of it goes too. A null text stays null.
    """
    columns = documents.columns
    rest = [c for c in columns if c != "text"]
    # the user's columns travel as one, so that no name of theirs is a helper's
    packed = documents.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in rest)).alias("_row"))
    rows = with_spans(packed, length, hot, sort_bytes)
    at, n = columns.index("text"), len(columns)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [left.decode("utf-8", "ignore") for left, _, _ in _each(batch, at, n, n + 1)]
            made = pa.array(texts, pa.string(), mask=batch.column(at).is_null().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([made if k == at else batch.column(k) for k in range(n)], names=columns)

    unpacked = [F.col("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in columns]
    return rows.select(*unpacked, F.col("_froms").alias("_f"), F.col("_tos").alias("_t")).mapInArrow(task, documents.schema)
