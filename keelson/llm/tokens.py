"""Byte-level BPE ids of whole texts, from the vocabulary file of a public tokenizer."""

from __future__ import annotations

import functools
import json
import struct

#: Fixed value: the pre-tokenizer pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words kept per process; others are encoded again.
CACHED = 300_000


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable character: itself where it
    is printable in Latin-1, else the next free code point from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Words(dict):
    """Ids (as bytes) of a space and the word after it, so that each word is encoded once."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes | None:
        if not word or word[0].isspace() or word[-1].isspace():
            return None  # white space meets white space here: the text can't be cut at this space
        ids = self.encode(" " + word)
        if len(self) < CACHED:
            self[word] = ids
        return ids


class Encoder:
    """``ids(text)``: unsigned 32-bit little-endian ids, those of
    ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``.

    The pre-tokenizer never joins across a single space between two other characters, so
    such a space is a cut; texts with other runs of white space are encoded in one go.
    """

    def __init__(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte = _byte_of_char()
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.encoding = tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.words = _Words(self.whole)
        self.path = path

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    def whole(self, text: str) -> bytes:
        try:
            ids = self.encoding.encode(text, allowed_special="all")
        except ValueError:  # its pattern matcher gives up on very long runs of white space
            ids = self.library.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: str) -> bytes:
        parts = text.split(" ")
        if parts[0][-1:].isspace():
            return self.whole(text)
        try:
            return self.whole(parts[0]) + b"".join(map(self.words.__getitem__, parts[1:]))
        except TypeError:  # a None: see _Words
            return self.whole(text)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
