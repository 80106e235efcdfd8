"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

A is a byte-level BPE of the tokenizers library, B a SentencePiece model with byte fallback. Both
read a space and the text. The character offsets that the libraries report are coarse cuts: a token
that ends with a character ends at that character's last byte. Where a token ends inside a character
(several tokens spell one, as byte tokens do) its end is the cut before it plus the bytes decoded
since then.

A text is taken apart at single spaces between other characters. No token of A or B crosses such a
place, and what stands on one side has no influence on the tokens of the other, so the alignment of
a text is that of its units, one after another. A unit is encoded and aligned once in a block of texts,
many units at a time as one run with single spaces between them.

What is counted over the corpus (how often an A id and a B id overlap) is summed within a block
first; a block gets back the counts of its own pairs only.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shelfwise.session import materialize

#: Vocabulary files: A and B. They must lie at the same place on every machine.
BYTE_FILE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text and units of a block; a longer text is a block of its own.
BLOCK_BYTES = 20_000_000
BLOCK_UNITS = 400_000
#: Characters of new units that are encoded at once.
ENCODE_CHARS = 20_000
_SPACE_SIGN = "▁"
_UNITS = re.compile(r"(?<=\S) (?=\S)")
_WIDE_SPACE = re.compile(r"\s[ ]|[ ](?:\s|\Z)")


def _split(text: str) -> list[str]:
    """The units of a text that isn't empty; where each space stands alone between other characters, they are its words."""
    return _UNITS.split(text) if text[0] == " " or _WIDE_SPACE.search(text) else text.split(" ")


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, with the bytes of every id."""

    _loaded: dict[tuple, Tokenizers] = {}

    @classmethod
    def load(cls, byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE) -> Tokenizers:
        if (byte_file, piece_file) not in cls._loaded:
            cls._loaded[byte_file, piece_file] = cls(byte_file, piece_file)
        return cls._loaded[byte_file, piece_file]

    def __init__(self, byte_file: str, piece_file: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        alphabet = _byte_alphabet()
        with open(byte_file, encoding="utf-8") as lines:
            special = {t["id"] for t in json.load(lines)["added_tokens"]}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = token.encode() if i in special else bytes(map(alphabet.__getitem__, token))
        size = self.b.vocab_size()
        if max(len(self.a_bytes), size) > 1 << 16:
            raise ValueError("ids must fit in 16 bits")
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE_SIGN, " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)

        # each id as text with what follows it: another id of its side, then the other side (A) or the next group (B)
        self.names = [b"%d%c" % (i, c) for n, follows in ((len(self.a_bytes), b",|"), (size, b",;")) for i in range(n) for c in follows]
        self.widths = np.array(list(map(len, self.names)), np.int64)

    def encode_a(self, runs: list[str]) -> tuple[list[list[int]], list[list[tuple[int, int]]]]:
        """Ids and character offsets in the space and the run."""
        made = self.a.encode_batch([" " + r for r in runs], add_special_tokens=False)
        return [e.ids for e in made], [e.offsets for e in made]

    def encode_b(self, runs: list[str]) -> tuple[list[list[int]], list[list[tuple[int, int]]]]:
        """Ids and character offsets in the run; the space before it is the model's own."""
        made = self.b.encode(runs, return_type="offset_mapping", num_threads=1)
        return [e["ids"] for e in made], [e["offsets"] for e in made]


def _exact_ends(spans: np.ndarray, sizes: np.ndarray, byte_at: np.ndarray) -> np.ndarray:
    """Byte ends of tokens in a row.

    spans: their character offsets; sizes: their decoded bytes; byte_at: where each character begins, and
    the end. A token that adds a character and whose successor begins no earlier than it ends closes a
    character, and its end is a coarse cut; from the cut before it, other tokens end after the bytes they add.
    """
    ends, total = byte_at[spans[:, 1]], np.cumsum(sizes)
    closes = ends == total
    closes[1:] &= spans[1:, 1] > spans[:-1, 1]
    closes[:-1] &= spans[1:, 0] >= spans[:-1, 1]
    last = np.maximum.accumulate(np.where(closes, np.arange(len(spans)), -1))
    return np.where(last >= 0, ends[last], 0) + total - np.where(last >= 0, total[last], 0)


class Aligned:
    """Aligned units: numbers of tokens, groups and links of each, its groups as text, and its linked pairs.

    pairs[offsets[i] : offsets[i + 1]] are those of unit i: its B id, then its A id in 16 bits. Units whose
    bytes the tokens don't give back are not valid and have nothing.
    """

    def __init__(self, tokenizers: Tokenizers, units: list[str]):
        valid, counts, pairs = [np.zeros(0, bool)], [np.zeros((0, 4), np.int64)], [np.zeros(0, np.uint32)]
        self.texts: list[bytes] = []
        chars = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))
        starts = np.flatnonzero(np.diff(chars // ENCODE_CHARS, prepend=-1)).tolist()
        for first, stop in zip(starts, [*starts[1:], len(units)]):
            for known, made in zip((valid, counts, self.texts, pairs), _align(tokenizers, units[first:stop])):
                known += made if known is self.texts else [made]
        self.valid, self.counts, self.pairs = map(np.concatenate, (valid, counts, pairs))
        self.offsets = np.concatenate([[0], np.cumsum(self.counts[:, 3])])


def _runs(units: list[str]) -> list[str]:
    """The units, with single spaces between those that may stand side by side in a text."""
    run = " ".join(units)
    if not _WIDE_SPACE.search(run):
        return [run]
    runs, first = [], 0
    for i in range(1, len(units)):
        if units[i - 1][-1].isspace() or units[i][0].isspace():
            runs.append(" ".join(units[first:i]))
            first = i
    return [*runs, " ".join(units[first:])]


def _align(t: Tokenizers, units: list[str], joined_units: bool = True) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """(valid, counts, groups as text, pairs) of some units, all at once.

    Units that may follow one another are encoded as one run, as the tokens of each are the same there. Where
    the tokens of a run don't give back its bytes, or don't end where its units do, each unit is encoded alone.
    """
    runs = _runs(units) if joined_units else units
    joined = (" " + " ".join(units)).encode()
    data = np.frombuffer(joined, np.uint8)
    byte_at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    stops = byte_at[np.cumsum(np.fromiter(map(len, units), np.int64, len(units)) + 1)]  # where units end
    first_char = np.cumsum([0, *(len(r) + 1 for r in runs)])
    ids, ends, lengths = [], [], []
    valid = np.ones(len(units), bool)
    # A's spans count the space before the run, B's don't
    for (made, places), known, sizes, shift in ((t.encode_a(runs), t.a_bytes, t.a_sizes, 0), (t.encode_b(runs), t.b_bytes, t.b_sizes, 1)):
        n = np.fromiter(map(len, made), np.int64, len(made))
        flat = np.fromiter(chain.from_iterable(made), np.int64, int(n.sum()))
        total = np.cumsum(sizes[flat])
        at = np.searchsorted(total, stops)
        if b"".join(map(known.__getitem__, flat.tolist())) != joined or not n.all() or not np.array_equal(total[np.minimum(at, len(total) - 1)], stops):
            if joined_units:
                return _align(t, units, False)
            valid &= np.array([b"".join(map(known.__getitem__, m)) == (" " + u).encode() for m, u in zip(made, units)], bool)
            continue
        spans = np.fromiter(chain.from_iterable(chain.from_iterable(places)), np.int64, 2 * len(flat)).reshape(-1, 2)
        spans += np.repeat(first_char[:-1] + shift, n)[:, None]
        ids.append(flat)
        ends.append(_exact_ends(spans, sizes[flat], byte_at))
        lengths.append(np.diff(at + 1, prepend=0))
    if not valid.all():
        good = np.flatnonzero(valid).tolist()
        counts, texts, pairs = np.zeros((len(units), 4), np.int64), [b""] * len(units), np.zeros(0, np.uint32)
        if good:
            _, counts[valid], made, pairs = _align(t, [units[i] for i in good], False)
            for i, text in zip(good, made):
                texts[i] = text
        return valid, counts, texts, pairs

    (a, b), (a_ends, b_ends) = ids, ends
    here = np.zeros((2, len(data) + 1), bool)
    here[0, a_ends] = here[1, b_ends] = True
    before = np.cumsum(here, axis=1) - here  # how many tokens end before each byte
    cut, shared = here[0] | here[1], here[0] & here[1]
    cuts, both = np.flatnonzero(cut), np.flatnonzero(shared)  # what lies between two cuts is in one token of A and in one of B: a link
    pairs = ((b[before[1, cuts]] << 16) | a[before[0, cuts]]).astype(np.uint32)
    groups, links = np.cumsum(shared)[stops], np.cumsum(cut)[stops]
    counts = np.stack([*lengths, np.diff(groups, prepend=0), np.diff(links, prepend=0)], axis=1)
    return valid, counts, _group_texts(t, a, b, before[0, both] + 1, before[1, both] + 1, groups), pairs


def _group_texts(t: Tokenizers, a: np.ndarray, b: np.ndarray, a_stops: np.ndarray, b_stops: np.ndarray, groups: np.ndarray) -> list[bytes]:
    """The groups of each unit as text: a_stops and b_stops say where groups end among the ids, groups where units do."""
    names = np.empty(len(a) + len(b), np.int64)
    for ids, stops, others, first in ((a, a_stops, np.r_[0, b_stops[:-1]], 0), (b, b_stops, a_stops, len(t.a_bytes))):
        at = 2 * (ids + first)
        at[stops - 1] += 1
        names[np.arange(len(ids)) + np.repeat(others, np.diff(stops, prepend=0))] = at
    text = b"".join(map(t.names.__getitem__, names.tolist()))
    bounds = np.r_[0, np.cumsum(t.widths[names])[(a_stops + b_stops)[groups - 1] - 1]].tolist()
    return [text[i : j - 1] for i, j in zip(bounds, bounds[1:])]


_DOC = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
_STORED = pa.schema([("block", pa.int64()), ("kind", pa.int32()), *_DOC, ("units", pa.binary()), ("offsets", pa.binary()), ("pairs", pa.binary()), ("uses", pa.binary())])
_STORED_SQL = "block long, kind int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, units binary, offsets binary, pairs binary, uses binary"
_NUMBERS, _TEXT = 1, 2


class _Places(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        place = self[key] = len(self)
        return place


class _Block:
    """Texts of one block and the units they are made of."""

    def __init__(self, number: int):
        self.number, self.places, self.ids, self.texts, self.bytes = number, _Places(), [], [], 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        parts = _split(text) if text else []
        self.ids.append(doc_id)
        self.texts.append(np.fromiter(map(self.places.__getitem__, parts), np.int32, len(parts)))
        self.bytes += len(text or "")

    def full(self, block_bytes: int = BLOCK_BYTES) -> bool:
        return self.bytes >= block_bytes or len(self.places) >= BLOCK_UNITS

    def batches(self, tokenizers: Tokenizers) -> Iterator[pa.RecordBatch]:
        collects = gc.isenabled()
        gc.disable()  # spans come as millions of small tuples, none of them in a cycle
        try:
            known = Aligned(tokenizers, list(self.places))
        finally:
            if collects:
                gc.enable()
        self.places = _Places()
        uses = np.zeros(len(known.valid), np.int64)
        rows = []
        for doc_id, used in zip(self.ids, self.texts):
            if len(used) and known.valid[used].all():
                np.add.at(uses, used, 1)
                totals = known.counts[used].sum(axis=0).tolist()
                digest = hashlib.sha256(b";".join([known.texts[p] for p in used.tolist()])).hexdigest()
                rows.append((doc_id, *totals, digest, used.tobytes(), None, None, None))
            else:
                rows.append((doc_id, 0, 0, 0, 0, "", b"", None, None, None))
        numbers = (known.offsets.tobytes(), known.pairs.tobytes(), uses.tobytes())
        yield self._batch([(None,) * (len(_DOC) + 1) + numbers], _NUMBERS)
        for i in range(0, len(rows), 2000):
            yield self._batch(rows[i : i + 2000], _TEXT)

    def _batch(self, rows: list[tuple], kind: int) -> pa.RecordBatch:
        columns = [[self.number] * len(rows), [kind] * len(rows), *zip(*rows)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _STORED)], schema=_STORED)


def aligned_blocks(documents: DataFrame, byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Texts by block with the units they are made of, and one row for each block with the pairs of its units."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers.load(byte_file, piece_file)
        number = TaskContext.get().partitionId() << 32
        block = _Block(number)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(doc_id, text.as_py())
                if block.full(block_bytes):
                    yield from block.batches(tokenizers)
                    number += 1
                    block = _Block(number)
        if block.ids:
            yield from block.batches(tokenizers)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, _STORED_SQL)


def _block_pairs(blocks: DataFrame) -> DataFrame:
    """(block, pair, n): how many links of a block hold a pair; a pair is its B id, then its A id in 16 bits."""
    schema = pa.schema([("block", pa.int64()), ("pair", pa.int64()), ("n", pa.int64())])

    def task(batches):
        for batch in batches:
            for block, offsets, pairs, uses in zip(*batch.columns):
                offsets = np.frombuffer(offsets.as_buffer(), np.int64)
                uses = np.repeat(np.frombuffer(uses.as_buffer(), np.int64), np.diff(offsets))
                pairs = np.frombuffer(pairs.as_buffer(), np.uint32)
                order = np.argsort(pairs, kind="stable")
                pairs, uses = pairs[order], uses[order]
                if not len(pairs):
                    continue
                heads = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
                n = np.add.reduceat(uses, heads)
                keep = n > 0
                found = pairs[heads][keep].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block.as_py())), pa.array(found), pa.array(n[keep])], schema=schema)

    rows = blocks.filter(F.col("kind") == _NUMBERS).select("block", "offsets", "pairs", "uses")
    return rows.mapInArrow(task, "block long, pair long, n long")


def pair_counts(blocks_of_pairs: DataFrame) -> DataFrame:
    """(pair, count, best): links of the corpus that hold a pair, and whether no pair of the same B id has more.

    The highest counts are a row for each id of B, so their broadcast is bounded by its vocabulary.
    """
    counts = blocks_of_pairs.groupBy("pair").agg(F.sum("n").alias("count"))
    top = counts.groupBy(F.shiftright("pair", 16).alias("b")).agg(F.max("count").alias("top"))
    return counts.join(F.broadcast(top), F.shiftright("pair", 16) == F.col("b")).select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def align(documents: DataFrame, byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row of ``documents`` (doc_id, text).

    Null and empty texts, and texts that the bytes of one tokenizer's tokens don't give back (one that
    holds U+2581, say), have no tokens: zeros and an empty ``groups_sha256``. A row without a doc_id
    keeps its results; rows that share an id or a text have one row each, and each counts. Other columns
    are not read. A text of any length is read whole; it needs memory in proportion to its tokens, and
    an empty table gives no rows.
    """
    blocks = materialize(aligned_blocks(documents, byte_file, piece_file, block_bytes), "aligned")
    pairs = materialize(_block_pairs(blocks), "block-pairs")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in blocks.schema.fields if f.name not in ("block", "kind")]
    counted = pairs.select("block", "pair").join(pair_counts(pairs), "pair").select("block", F.lit(0).alias("kind"), *empty, "pair", "count", "best")
    texts = blocks.select("*", F.lit(None).cast("long").alias("pair"), F.lit(None).cast("long").alias("count"), F.lit(None).cast("boolean").alias("best"))
    schema = pa.schema([*_DOC[:-1], ("n_best", pa.int64()), ("count_sum", pa.int64()), _DOC[-1]])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, found, best, total = None, [], None, None
        for batch in batches:
            block, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(kind)]):
                part = batch.slice(i, j - i)
                if block[i] != open_:
                    open_, found = block[i], []
                if kind[i] == 0:
                    found.append((part.column("pair").to_numpy(), part.column("count").to_numpy(), part.column("best").to_numpy(zero_copy_only=False).astype(np.int64)))
                elif kind[i] == _NUMBERS:
                    best, total = _unit_values(part, found)
                    found = []
                else:
                    sums = [_text_values(u, best, total) for u in part.column("units")]
                    out = {"n_best": pa.array([s[0] for s in sums], pa.int64()), "count_sum": pa.array([s[1] for s in sums], pa.int64())}
                    yield pa.RecordBatch.from_arrays([out[f.name] if f.name in out else part.column(f.name) for f in schema], schema=schema)

    rows = counted.unionByName(texts).repartition(F.col("block")).sortWithinPartitions("block", "kind", "pair")
    return rows.mapInArrow(task, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _unit_values(row: pa.RecordBatch, found: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """For each unit of a block: its links whose count is the highest of their B id, and the sum of their counts."""
    offsets = np.frombuffer(row.column("offsets")[0].as_buffer(), np.int64)
    pairs = np.frombuffer(row.column("pairs")[0].as_buffer(), np.uint32).astype(np.int64)
    best, total = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    if found and len(pairs):
        known, count, top = (np.concatenate(c) for c in zip(*found))
        at = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
        here = known[at] == pairs  # pairs of units that only texts without tokens use aren't counted
        best[here], total[here] = top[at[here]], count[at[here]]
    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (best, total)]
    return sums[0][offsets[1:]] - sums[0][offsets[:-1]], sums[1][offsets[1:]] - sums[1][offsets[:-1]]


def _text_values(units: pa.Scalar, best: np.ndarray, total: np.ndarray) -> tuple[int, int]:
    places = np.frombuffer(units.as_buffer(), np.int32)
    return (int(best[places].sum()), int(total[places].sum())) if len(places) else (0, 0)
