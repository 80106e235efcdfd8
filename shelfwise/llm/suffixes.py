"""Two-stage suffix sorting of byte strings up to a bounded depth, and adjacent common prefixes."""

from __future__ import annotations

import numpy as np

_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def eight_bytes(text: np.ndarray, padding: int) -> np.ndarray:
    """At each position the next eight bytes as one number in text order; zeros follow the end."""
    x = np.zeros(len(text) + padding + 8, np.uint64)
    x[: len(text)] = text
    for step in (1, 2, 4):
        x[:-step] = (x[:-step] << np.uint64(8 * step)) | x[step:]
    return x[: len(text) + padding]


def descending(text: np.ndarray) -> np.ndarray:
    """Whether a suffix is larger than its successor; the end of the text is smaller than any byte."""
    n = len(text)
    falls = np.ones(n, bool)
    change = np.flatnonzero(text[1:] != text[:-1])
    # within a run of one byte the order is that at the end of the run
    at = np.searchsorted(change, np.arange(n - 1)) if n > 1 else np.zeros(0, np.int64)
    known = at < len(change)
    ends = change[at[known]]
    falls[:-1][known] = text[ends] > text[ends + 1]
    return falls


def sort_direct(words: np.ndarray, positions: np.ndarray, depth: int, same: np.ndarray) -> np.ndarray:
    """``positions`` in the order of the ``depth`` bytes that follow; equal strings in any order.

    same: a hash of those bytes at each position; a group of one hash needs no further comparison.
    """
    order = positions[np.argsort(words[positions], kind="stable")]
    first = words[order]
    tied = np.zeros(len(order) + 1, bool)
    tied[1:-1] = first[1:] == first[:-1]
    for at in range(8, depth, 8):
        # groups of ties in the order so far, as runs of ``tied``
        member = np.flatnonzero(tied[1:] | tied[:-1])
        if not len(member):
            break
        begins = ~tied[member]
        group = np.cumsum(begins) - 1
        heads = np.flatnonzero(begins)
        hashes = same[order[member]]
        mixed = np.minimum.reduceat(hashes, heads) != np.maximum.reduceat(hashes, heads)
        open_ = mixed[group]
        tied[member[~open_]] = False
        member, group = member[open_], group[open_]
        if not len(member):
            break
        rows = order[member]
        keys = words[rows + at]
        again = np.lexsort((keys, group))
        order[member] = rows[again]
        keys, group = keys[again], group[again]
        tied[member[1:]] = (keys[1:] == keys[:-1]) & (group[1:] == group[:-1])
    return order


def two_stage_order(text: np.ndarray, wanted: np.ndarray, depth: int, same: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The wanted positions in the order of their suffixes, exact in the first ``depth`` bytes.

    wanted: a mask over the text. Suffixes smaller than their successors are sorted directly. The
    others are induced: a scan over the buckets of first bytes, from the smallest, puts the
    predecessor of every suffix it meets at the end of what its own bucket has so far.
    """
    falls = descending(text)
    needed = wanted.copy()
    edge = np.flatnonzero(wanted)
    while len(edge):  # a larger suffix is induced from its successor, so that is needed too
        edge = edge[falls[edge]] + 1
        edge = edge[edge < len(text)]
        edge = edge[~needed[edge]]
        needed[edge] = True
    rising = sort_direct(words, np.flatnonzero(needed & ~falls), depth, same)
    bounds = np.searchsorted(text[rising], np.arange(257))
    buckets: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced = needed & falls
    if induced[-1]:
        buckets[text[-1]].append(np.array([len(text) - 1]))
    sorted_parts = []
    for c in range(256):
        front = np.concatenate(buckets[c]) if buckets[c] else np.zeros(0, np.int64)
        parts = []
        while len(front):
            parts.append(front)
            before = front[front > 0] - 1
            front = before[induced[before] & (text[before] == c)]
        parts.append(rising[bounds[c] : bounds[c + 1]])
        bucket = np.concatenate(parts)
        buckets[c] = []
        if not len(bucket):
            continue
        sorted_parts.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[induced[before] & (text[before] > c)]
        byte = text[before]
        by_byte = np.argsort(byte, kind="stable")
        before, byte = before[by_byte], byte[by_byte]
        heads = np.flatnonzero(np.r_[True, byte[1:] != byte[:-1]]) if len(byte) else []
        for i, j in zip(heads, [*heads[1:], len(byte)]):
            buckets[byte[i]].append(before[i:j])
    order = np.concatenate(sorted_parts) if sorted_parts else np.zeros(0, np.int64)
    return order[wanted[order]]


def adjacent_prefixes(words: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """For each two neighbours of the order the length of their common prefix, ``limit`` at most."""
    a, b = order[:-1], order[1:]
    length = np.full(len(a), limit, np.int64)
    alive = np.arange(len(a))
    for at in range(0, limit, 8):
        differ = words[a[alive] + at] ^ words[b[alive] + at]
        done = differ != 0
        # equal leading bytes of the two words
        top = np.zeros(int(done.sum()), np.int64)
        rest = differ[done]
        for shift in (32, 16, 8):
            high = (rest >> np.uint64(64 - shift)) == 0
            top += np.where(high, shift // 8, 0)
            rest = np.where(high, rest << np.uint64(shift), rest)
        length[alive[done]] = np.minimum(limit, at + top)
        alive = alive[~done]
        if not len(alive):
            break
    return length
