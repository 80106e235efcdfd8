"""Text columns as byte arrays, and word and shingle hashes over them, for use inside Arrow tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes and rows of text handled at once; a longer text is handled alone. A task's arrays take some 60 times the
#: bytes, and its memory stays with the worker.
CHUNK_BYTES = 400_000
CHUNK_ROWS = 1000

WORD_BREAKS = bytes([0x20, *range(0x09, 0x0E)])
_IS_BREAK = np.isin(np.arange(256), list(WORD_BREAKS))
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

_DRAW = np.random.Generator(np.random.PCG64(20240607))
_BYTE_CODES = _DRAW.integers(0, 2**64, 256, dtype=np.uint64)
_FOLDED_CODES = _BYTE_CODES[_LOWER]
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_PLACE_CODES = _DRAW.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1) modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, CHUNK_BYTES + 1)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if n <= CHUNK_BYTES + 1:
            _powers[base] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the SplitMix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and the n + 1 offsets of its rows in them; null is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of at most ``limit`` bytes and ``CHUNK_ROWS`` rows, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = min(max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1), i + CHUNK_ROWS, n)
        yield i, j
        i = j


def release() -> None:
    """Gives freed memory back to the system: a worker waits for its next task with the heap that it has."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(i, j, bytes, offsets) of each chunk of rows."""
    data, offsets = as_bytes(column)
    for i, j in chunks(offsets, limit):
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
    release()


def prefix_hashes(data: np.ndarray, codes: np.ndarray = _BYTE_CODES) -> np.ndarray:
    """h[j] - h[i] identifies data[i:j] up to the factor base**i (modulo 2**64)."""
    h = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * powers(_BASE, len(data)), out=h[1:])
    return h


def span_hashes(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[starts:ends] that do not depend on where the span lies."""
    return mix((h[ends] - h[starts]) * powers(_BASE_INVERSE, len(h))[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the n + 1 offsets of the rows among them."""
    inside = ~_IS_BREAK[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    rows = offsets[:-1][offsets[:-1] < len(data)]
    first[rows] = inside[rows]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    rows = offsets[1:][offsets[1:] > 0] - 1
    last[rows] = inside[rows]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """For each row its distinct shingles as sorted 64-bit hashes.

    A shingle is ``width`` words in a row with A-Z in lower case; a row with fewer words has its
    whole sequence as one, and a row without words has none.
    """
    starts, ends, rows = word_spans(data, offsets)
    counts = np.diff(rows)
    words = span_hashes(prefix_hashes(data, _FOLDED_CODES), starts, ends)
    places = _PLACE_CODES[:width]
    full = max(0, len(words) - width + 1)
    wide = np.zeros(full, np.uint64)
    for t in range(width if full else 0):
        wide += words[t : t + full] * places[t]
    wide = mix(wide)
    found = []
    for i, n in zip(rows[:-1].tolist(), counts.tolist()):
        if n >= width:
            found.append(np.unique(wide[i : i + n - width + 1]))
        elif n:
            short = (words[i : i + n] * places[:n]).sum(dtype=np.uint64, keepdims=True)
            found.append(mix(short + _PLACE_CODES[-n : len(_PLACE_CODES) - n + 1]))
        else:
            found.append(wide[:0])
    return found
