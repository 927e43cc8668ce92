"""Byte-level BPE ids of a public tokenizer file.

Ids equal ``Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids``: ordinary texts take a faster encoder over
the same vocabulary; texts with a special token's string, or with a run that the faster one can't hold, take that call itself.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

#: The pre-token pattern of the vocabulary; a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG = 100_000
LONG_RUN = re.compile(r"\S{%d}|\s{%d}" % (LONG, LONG))
#: A single space between two non-space characters always starts a pre-token: texts may be cut there.
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The vocabulary file writes bytes as letters: printable ones as themselves, the others as letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """``limit``: keep only the first so many ids (byte letters and merges), a smaller vocabulary of the same file."""

    def __init__(self, path: str, limit: int | None = None):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = byte_letters()
        ranks = {bytes(letters[ch] for ch in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special and (limit is None or i < limit)}
        self.size = len(ranks)
        self.fast = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.whole = Tokenizer.from_file(path) if limit is None else None

    def ids(self, text: str) -> list[int]:
        if self.whole is not None and (any(s in text for s in self.special) or (len(text) >= LONG and LONG_RUN.search(text))):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit bytes."""
        return np.array(self.ids(text), "<u4").tobytes()


@lru_cache(4)
def encoder(path: str, limit: int | None = None) -> Encoder:
    return Encoder(path, limit)
