"""Byte-level BPE token ids of texts, with a public vocabulary of ranks."""

from __future__ import annotations

import base64
import re

#: Vocabulary file: one token (base64) and its rank to a line.
RANKS_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: What splits a text before merges; a fixed value that belongs to the vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LOOKAHEAD = r"\s+(?!\S)|"
_WIDE_SPACE = re.compile(r"\s\s")


class Encoder:
    """Ids of whole texts; ``end`` is a free id that ends a document."""

    _loaded: dict[str, Encoder] = {}

    @classmethod
    def load(cls, ranks_file: str = RANKS_FILE) -> Encoder:
        if ranks_file not in cls._loaded:
            cls._loaded[ranks_file] = cls(ranks_file)
        return cls._loaded[ranks_file]

    def __init__(self, ranks_file: str):
        import tiktoken

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.end = max(ranks.values()) + 1
        self.full = tiktoken.Encoding("full", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        # the lookahead only matters where white space follows white space; without it splitting is much faster
        self.narrow = tiktoken.Encoding("narrow", pat_str=SPLIT.replace(_LOOKAHEAD, ""), mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        return (self.full if _WIDE_SPACE.search(text) else self.narrow).encode_ordinary(text)

    def decode(self, ids: list[int]) -> str:
        return self.full.decode_bytes([i for i in ids if i != self.end]).decode()
