"""Sampled SentencePiece segmentations by forward filtering and backward sampling.

The pieces of a vocabulary that match a text form a lattice of segmentations, each weighted by the
product of its pieces' weights. Forward filtering sums the weights of all ways to reach a place;
backward sampling draws the last piece in proportion, then the one before it, and so on: an exact
draw from all segmentations. The random numbers come from the row's key, the place in the row and
the seed, so a row has one segmentation, in whatever task it runs.

Text is cut where no piece of the vocabulary can cross (before spaces, around line ends), and the
lattice of each distinct cut is filtered once for a chunk of rows. Spaces stand for the sign that the
vocabulary has for them; what no piece covers is spelt in byte pieces, so decoding gives the text back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from shelfwise.llm.texts import mix, powers, text_chunks

#: Vocabulary file of SentencePiece's format.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 250_000
_SPACE_SIGN = "▁"
#: Leading bits of a piece's hash that are looked up in a table.
_LEAD = 18
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 2**64)
_CUTS = re.compile(r" +[^ \n]*|[^ \n]+|\n")


def _hashes(points: np.ndarray) -> np.ndarray:
    h = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(mix(points.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(points)), out=h[1:])
    return h


class Vocabulary:
    """Pieces by hash, with log weights -log(2 + rank) as the files of merges have ranks for scores."""

    _loaded: dict[tuple, Vocabulary] = {}

    @classmethod
    def load(cls, model_file: str, sharpness: float) -> Vocabulary:
        key = (model_file, sharpness)
        if key not in cls._loaded:
            cls._loaded[key] = cls(model_file, sharpness)
        return cls._loaded[key]

    def __init__(self, model_file: str, sharpness: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.vocab_size()
        self.bytes_of: list[bytes] = [b""] * size
        self.byte_ids = np.zeros(256, np.int32)
        known: dict[str, tuple[int, float]] = {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                text = piece.replace(_SPACE_SIGN, " ")
                self.bytes_of[i] = text.encode()
                known[text] = (i, -sharpness * float(np.log(2 + min(size, max(0, -model.get_score(i))))))
        self.byte_weight = -sharpness * float(np.log(2 + size))
        self.cuttable = not any(re.search(r"[^ ] |\n", text) for text in known)
        self.longest = max(map(len, known))
        table: dict[int, tuple[int, float]] = {}
        for text, (i, weight) in known.items():
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            h = _hashes(points)
            for n in range(1, len(points) + 1):
                name = int(mix(h[n : n + 1] + np.uint64(n))[0])
                table.setdefault(name, (-1, 0.0))
            table[name] = (i, weight)
        self.keys = np.array(sorted(table), np.uint64)
        self.ids = np.array([table[int(k)][0] for k in self.keys], np.int32)
        self.weights = np.array([table[int(k)][1] for k in self.keys])
        # keys by their leading bits: where those with so many leading bits begin
        self.heads = np.searchsorted(self.keys, np.arange(1 << _LEAD, dtype=np.uint64) << np.uint64(64 - _LEAD)).astype(np.int32)
        self.probes = int(np.bincount((self.keys >> np.uint64(64 - _LEAD)).astype(np.int64)).max())
        self.piece_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.piece_offsets = np.concatenate([[0], np.cumsum([len(b) for b in self.bytes_of])])

    def find(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which names are known, their places among the keys)."""
        at = self.heads[(names >> np.uint64(64 - _LEAD)).astype(np.int64)]
        hits, places = [], []
        left = np.arange(len(names))
        for _ in range(self.probes):
            inside = at < len(self.keys)
            left, at = left[inside], at[inside]
            known = self.keys[at]
            same = known == names[left]
            hits.append(left[same])
            places.append(at[same])
            on = known < names[left]
            left, at = left[on], at[on] + 1
        hits, places = np.concatenate(hits), np.concatenate(places)
        order = np.argsort(hits, kind="stable")
        return hits[order], places[order]

    def cuts(self, text: str) -> list[str]:
        return _CUTS.findall(text) if self.cuttable else [text] if text else []

    def decode(self, ids: np.ndarray) -> bytes:
        return _take_runs(self.piece_bytes, self.piece_offsets[:-1][ids], np.diff(self.piece_offsets)[ids]).tobytes()


def _take_runs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """data[start:start + size] of all runs, one after another."""
    ends = np.cumsum(sizes)
    if not len(sizes) or not ends[-1]:
        return data[:0]
    return data[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])]


class Lattice:
    """All segmentations of some strings, forward filtered.

    Node i + k + offset of string i is its place k. Edges are sorted by the node at which they end.
    """

    def __init__(self, vocabulary: Vocabulary, strings: list[str]):
        points = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(s) for s in strings], np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        owner = np.repeat(np.arange(len(strings)), sizes)
        self.first = offsets[:-1] + np.arange(len(strings))
        self.last = self.first + sizes
        h, inverse = _hashes(points), powers(_INVERSE, len(points) + 1)
        stops = offsets[1:][owner]  # end of the string that holds a place
        begin, length, ids, weights = [], [], [], []
        alive = np.arange(len(points))
        for n in range(1, vocabulary.longest + 1):
            alive = alive[alive + n <= stops[alive]]
            if not len(alive):
                break
            names = mix((h[alive + n] - h[alive]) * inverse[alive] + np.uint64(n))
            found, at = vocabulary.find(names)
            alive = alive[found]
            whole = vocabulary.ids[at] >= 0
            begin.append(alive[whole])
            length.append(np.full(int(whole.sum()), n))
            ids.append(vocabulary.ids[at[whole]].astype(np.int64))
            weights.append(vocabulary.weights[at[whole]])
            if n == 1:
                # a character that is no piece is spelt in bytes; its edge has the number of its code point
                bare = np.ones(len(points), bool)
                bare[alive[whole]] = False
                spelt = np.flatnonzero(bare)
                begin.append(spelt)
                length.append(np.ones(len(spelt), np.int64))
                ids.append(-1 - points[spelt].astype(np.int64))
                weights.append(vocabulary.byte_weight * np.where(points[spelt] < 0x80, 1, np.where(points[spelt] < 0x800, 2, np.where(points[spelt] < 0x10000, 3, 4))))
        if not begin:
            begin, length, ids, weights = ([np.zeros(0, np.int64)] for _ in range(4))
        begin, length = np.concatenate(begin), np.concatenate(length)
        ids, weights = np.concatenate(ids), np.concatenate(weights).astype(np.float64)
        start = begin + owner[begin] if len(begin) else begin
        end = start + length
        order = np.argsort(end, kind="stable")
        self.start, self.ids, end, weights = start[order], ids[order], end[order], weights[order]
        self._filter(end, weights, end - self.first[owner[begin[order]]] if len(begin) else end)

    def _filter(self, end: np.ndarray, weights: np.ndarray, place: np.ndarray) -> None:
        nodes = int(self.last[-1]) + 1 if len(self.last) else 0
        reach = np.full(nodes, -np.inf)
        reach[self.first] = 0
        by_place = np.argsort(place, kind="stable")
        bounds = np.searchsorted(place[by_place], np.arange(1, (int(place.max()) if len(place) else 0) + 2))
        for i, j in zip(bounds[:-1], bounds[1:]):
            edges = by_place[i:j]
            ends = end[edges]
            heads = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]])
            reach[ends[heads]] = np.logaddexp.reduceat(reach[self.start[edges]] + weights[edges], heads)
        share = np.exp(reach[self.start] + weights - reach[end])
        total = np.cumsum(share)
        heads = np.flatnonzero(np.r_[True, end[1:] != end[:-1]]) if len(end) else np.zeros(0, np.int64)
        sizes = np.diff(np.r_[heads, len(end)])
        before = np.repeat(np.r_[0.0, total[heads[1:] - 1]] if len(heads) else np.zeros(0), sizes)
        within = np.minimum(total - before, 1 - 1e-12)
        within[np.r_[heads[1:], len(end)][: len(heads)] - 1] = 1.0
        self.within = within
        self.heads = np.zeros(nodes, np.int64)
        self.heads[end[heads]] = heads

    def sample(self, which: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(edge ids, numbers of edges) of one draw for each string of ``which``, with its random key."""
        node, stop = self.last[which].copy(), self.first[which]
        active = np.flatnonzero(node > stop)
        counts = np.zeros(len(which), np.int64)
        drawn, owners = [], []
        step = 0
        while len(active):
            noise = mix(keys[active] + np.uint64(step * 0x9E3779B97F4A7C15 % 2**64))
            u = (noise >> np.uint64(11)).astype(np.float64) / 2**53
            edge = self.heads[node[active]]
            on = np.flatnonzero(self.within[edge] <= u)
            while len(on):  # the next edge into the same node; the last one's share ends at 1
                edge[on] += 1
                on = on[self.within[edge[on]] <= u[on]]
            drawn.append(self.ids[edge])
            owners.append(active)
            counts[active] += 1
            node[active] = self.start[edge]
            active = active[node[active] > stop[active]]
            step += 1
        made = np.zeros(int(counts.sum()), np.int64)
        ends = np.cumsum(counts)
        for k, (ids, who) in enumerate(zip(drawn, owners)):
            made[ends[who] - 1 - k] = ids
        return made, counts


def _spell(vocabulary: Vocabulary, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids, and how many each edge has: one, or the bytes of a character."""
    bare = np.flatnonzero(edges < 0)
    if not len(bare):
        return edges.astype(np.int32), np.ones(len(edges), np.int64)
    spelt = [chr(-1 - e).encode("utf-8", "surrogatepass") for e in edges[bare].tolist()]
    sizes = np.ones(len(edges), np.int64)
    sizes[bare] = [len(b) for b in spelt]
    ids = np.repeat(edges, sizes).astype(np.int32)
    starts = (np.cumsum(sizes) - sizes)[bare]
    at = np.repeat(starts - (np.cumsum(sizes[bare]) - sizes[bare]), sizes[bare]) + np.arange(int(sizes[bare].sum()))
    ids[at] = vocabulary.byte_ids[np.frombuffer(b"".join(spelt), np.uint8)]
    return ids, sizes


def sample_rows(vocabulary: Vocabulary, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece ids of all rows, number of each row); keys: one 64-bit number for each row."""
    number: dict[str, int] = {}
    which, per_row = [], []
    for text in texts:
        cuts = vocabulary.cuts(text)
        per_row.append(len(cuts))
        which += [number.setdefault(c, len(number)) for c in cuts]
    if not which:
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    per_row = np.array(per_row, np.int64)
    ends = np.cumsum(per_row)
    place = np.arange(len(which)) - np.repeat(ends - per_row, per_row)
    seeds = mix(np.repeat(keys, per_row) ^ mix(place.astype(np.uint64) + np.uint64(1)))
    edges, counts = Lattice(vocabulary, list(number)).sample(np.array(which), seeds)
    ids, sizes = _spell(vocabulary, edges)
    of_row = np.repeat(np.repeat(np.arange(len(texts)), per_row), counts)
    return ids, np.bincount(of_row, weights=sizes, minlength=len(texts)).astype(np.int64)


def encode(
    documents: DataFrame, model_file: str = MODEL_FILE, sharpness: float = 1.5, seed: int = 0, key: str = "doc_id"
) -> DataFrame:
    """``documents`` with piece_ids and n_pieces in place of ``text``.

    sharpness: exponent of the piece weights; the larger, the closer the draws are to the likeliest
    segmentation. key: the (integer) column that seeds a row. A null text is empty and has no
    pieces; a null key counts as 0. Rows with equal keys and texts have equal pieces. A column that
    is already called piece_ids or n_pieces is replaced.
    """
    rest = [c for c in documents.columns if c not in ("text", "piece_ids", "n_pieces")]
    # in the task: the text, the key, then the other columns, by place
    rows = documents.select(F.col("text").alias("_t"), F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(0)).alias("_k"), *(F.col(f"`{c}`") for c in rest))
    fields = [documents.schema[c] for c in rest]
    schema = T.StructType(fields).add("piece_ids", T.ArrayType(T.IntegerType())).add("n_pieces", T.IntegerType())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.load(model_file, sharpness)
        for batch in batches:
            seeds = mix(batch.column(1).to_numpy().view(np.uint64) + mix(np.array([seed + 1], np.int64).view(np.uint64)))
            for i, j, data, offsets in text_chunks(batch.column(0), CHUNK):
                whole = data.tobytes()
                texts = [whole[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                ids, counts = sample_rows(vocabulary, texts, seeds[i:j])
                bounds = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                columns = [batch.column(k).slice(i, j - i) for k in range(2, batch.num_columns)]
                columns += [pa.ListArray.from_arrays(bounds, pa.array(ids, pa.int32())), pa.array(counts, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(task, schema)


def decode(encoded: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """``encoded`` with the text of its piece_ids as the last column ``text``; null ids decode to the empty text."""
    rest = [c for c in encoded.columns if c != "text"]
    at = rest.index("piece_ids")
    schema = T.StructType([encoded.schema[c] for c in rest]).add("text", T.StringType())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.load(model_file, 1.0)
        for batch in batches:
            texts = [vocabulary.decode(r.values.to_numpy()).decode() if r.is_valid else "" for r in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return encoded.select(*(F.col(f"`{c}`") for c in rest)).mapInArrow(task, schema)


def with_decoded_digest(encoded: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """doc_id, piece_ids, n_pieces and decoded_sha256, the digest of the decoded text in UTF-8."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.load(model_file, 1.0)
        for batch in batches:
            digests = [hashlib.sha256(vocabulary.decode(r.values.to_numpy())).hexdigest() for r in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())], names=["doc_id", "piece_ids", "n_pieces", "decoded_sha256"])

    rows = encoded.select(F.col("doc_id").cast("long"), "piece_ids", "n_pieces")
    return rows.mapInArrow(task, "doc_id long, piece_ids array<int>, n_pieces int, decoded_sha256 string")
